"""Live red/green status changes on a stream of alerts.

``status_changes_stream`` emits ``red`` as soon as an alert arrives for a
green key, and ``green`` once the key has had no alert for ``ttl``: either
when a later alert shows the gap (> ttl) or when the watermark passes
``last alert + ttl`` (event-time timeout). State is one small row per key
that is currently red; it is dropped when the key turns green.

Before the shuffle every input task reduces its Arrow batches of alerts to
runs (first, last) per key, alerts no further than ``ttl`` apart: a key that
holds a third of all alerts is reduced where its rows are read, and its state
function sees a few runs a task, not alerts. The function joins them again;
memory follows the number of runs. Bound the backlog of a catch-up with the
source's files (or offsets) per trigger.

The watermark delay may not exceed ``ttl``: within it, an alert that arrives
out of order can only widen the episode it falls into or stand before one
that has not been reported; with a longer delay a whole earlier episode
could still arrive after a later one was reported. A ``red`` that was
emitted is never moved by an earlier alert of the same episode.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from pylonflow.functions.timeutil import duration_us, require_instant, spark_duration
from pylonflow.session import ship_package

STATE_SCHEMA = T.StructType([T.StructField("last_alert_us", T.LongType())])


def merge_runs(runs: np.ndarray, ttl_us: int) -> np.ndarray:
    """Sorted (first, last) runs, joined where the gap is at most ``ttl_us``."""
    if len(runs) < 2:
        return runs
    runs = runs[np.lexsort((runs[:, 1], runs[:, 0]))]
    reach = np.maximum.accumulate(runs[:, 1])
    start = np.append(True, runs[1:, 0] - reach[:-1] > ttl_us)
    ends = reach[np.append(np.flatnonzero(start)[1:] - 1, len(runs) - 1)]
    return np.stack([runs[start, 0], ends], 1)


def runs_of(keys: pa.Array, t: np.ndarray, ttl_us: int) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """(key, first, last) of the runs of each key in one batch of alerts; null keys are a key."""
    coded = keys.dictionary_encode(null_encoding="encode")
    code = coded.indices.to_numpy(zero_copy_only=False)
    order = np.lexsort((t, code))
    code, t = code[order], t[order]
    start = np.flatnonzero(np.concatenate([[True], (code[1:] != code[:-1]) | (t[1:] - t[:-1] > ttl_us)])) if len(t) else np.zeros(0, int)
    ends = np.append(start[1:] - 1, len(t) - 1) if len(t) else start
    return coded.dictionary.take(pa.array(code[start])), t[start], t[ends]


def status_changes_stream(
    alerts: DataFrame,
    ttl: str = "90 seconds",
    alert_time: str = "window_end",
    key: str = "tower_id",
    watermark: str = "10 seconds",
) -> DataFrame:
    """Live red/green changes per key (append mode).

    Times cross into Python as epoch microseconds computed by Spark
    (``unix_micros``) and come back the same way, so no session time zone is
    involved. If ``last alert + ttl`` is already behind the watermark (an
    out-of-order alert after event time jumped ahead), green is emitted at
    once instead of arming a timer in the past.
    """
    require_instant(alerts, alert_time)
    ttl_us = duration_us(ttl)
    if duration_us(watermark) > ttl_us:
        raise ValueError(f"watermark {watermark!r} is longer than ttl {ttl!r}: an episode could arrive after a later one")
    ship_package(alerts.sparkSession)
    key_type = alerts.schema[key].dataType
    out_schema = T.StructType([T.StructField(key, key_type), T.StructField("changed_at_us", T.LongType()),
                               T.StructField("status", T.StringType())])

    def step(k: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        events: list[tuple[int, str]] = []
        if state.hasTimedOut:
            last = state.get[0]
            state.remove()
            events.append((last + ttl_us, "green"))
        else:
            last = state.get[0] if state.exists else None
            found = np.empty((0, 2), np.int64)
            for b in batches:
                runs = np.stack([b["_first"].to_numpy(np.int64), b["_last"].to_numpy(np.int64)], 1)
                found = merge_runs(np.concatenate([found, runs]), ttl_us)
            for first, end in found.tolist():
                if last is not None and first - last > ttl_us:
                    events.append((last + ttl_us, "green"))
                    last = None
                if last is None:
                    events.append((first, "red"))
                last = end if last is None else max(last, end)
            if last is not None:
                expiry_ms = (last + ttl_us) // 1000
                wm = state.getCurrentWatermarkMs()
                if wm is not None and wm > 0 and expiry_ms < wm:   # a timer there would be rejected
                    state.remove()
                    events.append((last + ttl_us, "green"))
                else:
                    state.update((last,))
                    state.setTimeoutTimestamp(expiry_ms)
        if events:
            yield pd.DataFrame({key: [k[0]] * len(events), "changed_at_us": [e[0] for e in events],
                                "status": [e[1] for e in events]})

    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys, first, last = runs_of(b.column(0), b.column(1).to_numpy(zero_copy_only=False), ttl_us)
            yield pa.RecordBatch.from_arrays([keys, pa.array(first), pa.array(last)], names=[key, "_first", "_last"])

    runs = (alerts.filter(F.col(alert_time).isNotNull()).select(key, F.unix_micros(F.col(alert_time)).alias("_t_us"))
            .mapInArrow(reduce, T.StructType([alerts.schema[key], T.StructField("_first", T.LongType()), T.StructField("_last", T.LongType())])))
    # the newest alert is the end of its run, so event time moves as it would by single alerts
    staged = runs.withColumn(alert_time, F.timestamp_micros("_last")).withWatermark(alert_time, spark_duration(watermark, allow_zero=True))
    return (staged.groupBy(key)
            .applyInPandasWithState(step, out_schema, STATE_SCHEMA, "append", GroupStateTimeout.EventTimeTimeout)
            .select(key, F.timestamp_micros("changed_at_us").alias("changed_at"), "status"))
