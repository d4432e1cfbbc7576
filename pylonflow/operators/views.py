"""Live views an operator console needs: latest reading per key, alert and
runbook feeds, red/green status with expiry."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pylonflow.functions.timeutil import as_time, shift_time, time_literal


def latest_by_key(
    df: DataFrame,
    keys: Sequence[str] = ("tower_id",),
    time_col: str = "event_time",
    value_cols: Sequence[str] = ("tower_name", "temperature", "signal_strength", "cpu_load"),
    tie_col: str | None = None,
    time_alias: str = "last_updated",
) -> DataFrame:
    """Latest row per key: ``max_by(values, (time, tie))``.

    A plain aggregate, so it pre-combines on the map side (one partial row per
    key and partition) before the exchange: a key holding a third of the rows
    still ships one row per input partition. Ties on ``time_col`` are broken
    by ``tie_col`` (largest wins), by default by the values themselves, so the
    row is the same on every run. On a stream run it in ``update`` (or
    ``complete``) output mode.
    """
    order = F.struct(F.col(time_col), *[F.col(c) for c in ([tie_col] if tie_col else value_cols)])
    payload = F.struct(*[F.col(c) for c in value_cols], F.col(time_col).alias(time_alias))
    return (df.groupBy(*keys).agg(F.max_by(payload, order).alias("_latest"))
            .select(*keys, "_latest.*"))


def latest_by_tower(telemetry: DataFrame) -> DataFrame:
    """Current temperature, signal, CPU and last-updated time per tower."""
    return latest_by_key(telemetry)


_TIES = ("tower_id", "tower_name", "latitude", "longitude")


def _orderable(t: T.DataType) -> bool:
    if isinstance(t, (T.MapType, T.VariantType)):
        return False
    if isinstance(t, T.StructType):
        return all(_orderable(f.dataType) for f in t.fields)
    if isinstance(t, T.ArrayType):
        return _orderable(t.elementType)
    return True


def alert_feed(alerts: DataFrame, limit: int | None = None, time_col: str = "window_end",
               tie_cols: Sequence[str] | None = None) -> DataFrame:
    """Alerts, newest first: ORDER BY window_end DESC, tower_id, ...; all of them, or the first ``limit``.

    Ties are broken by the grouping attributes present (an alert is unique per
    attributes and window), so the cut is deterministic. With a limit it is planned as
    ``TakeOrderedAndProject``: each partition keeps its own top n, only n rows
    per partition reach the final merge.
    """
    if tie_cols is not None:
        ties = list(tie_cols)
    else:   # tower attributes first, then every other orderable column: a total order
        first = [c for c in _TIES if c in alerts.columns]
        rest = [f.name for f in alerts.schema.fields
                if f.name != time_col and f.name not in first and _orderable(f.dataType)]
        ties = first + rest
    ordered = alerts.orderBy(F.col(time_col).desc(), *[F.col(c).asc() for c in ties])
    return ordered if limit is None else ordered.limit(limit)


def runbook_feed(responses: DataFrame, limit: int | None = None, time_col: str = "window_end",
                 tie_cols: Sequence[str] | None = None) -> DataFrame:
    """Runbooks, newest first, same ordering rule as ``alert_feed``."""
    return alert_feed(responses, limit, time_col, tie_cols)


def tower_status(
    towers: DataFrame,
    alerts: DataFrame,
    as_of: datetime | str | Column,
    ttl: str = "90 seconds",
    alert_time: str = "window_end",
    key: str = "tower_id",
) -> DataFrame:
    """One row per known tower: ``red`` if its latest alert at or before
    ``as_of`` is less than ``ttl`` old, otherwise ``green``.

    ``towers`` is any frame with the key (it is reduced to distinct keys);
    ``as_of`` may be a literal or a scalar-subquery column (``df.scalar()``).
    Both sides are aggregated to one row per tower before the left join, so
    the join input is the tower count, not the data size.
    """
    t, ntz = as_time(alerts, alert_time)
    now = time_literal(as_of, ntz)
    known = towers.select(key).distinct()
    last = (alerts.filter(t <= now)
            .groupBy(key).agg(F.max(t).alias("last_alert")))
    red = F.col("last_alert").isNotNull() & (now < shift_time(F.col("last_alert"), ttl, ntz))
    return (known.join(last, key, "left")
            .select(key, "last_alert", F.when(red, F.lit("red")).otherwise(F.lit("green")).alias("status")))
