"""Red episodes: maximal runs of alerts per key whose gaps are <= ttl.

A key turns red at an alert and back to green ``ttl`` after its last alert,
so an episode is [first alert, last alert + ttl). Gaps of exactly ``ttl``
stay in one episode.

Batch plan (gaps-and-islands, safe on hot keys):

1. rows are cut into (key, time bucket) partitions; one window pass inside
   each partition finds the local runs, which are then aggregated to one row
   each. A key that holds a third of all rows is spread over its buckets;
2. a run that is neither the first nor the last of its bucket has its
   neighbours in the same bucket, further than ``ttl`` away: it is an episode
   already;
3. only the first and last run of each bucket, two rows at most, meet in a
   per-key window that joins runs across bucket borders. What a key brings
   together there is bounded by its number of buckets, not by its rows or
   episodes.

Exchanges: one on (key, bucket) for the rows, one on key for the border
runs. The streaming twin uses ``session_window`` in append mode.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pylonflow.functions.timeutil import (
    as_time, duration_us, from_epoch_us, require_instant, spark_duration, to_epoch_us,
)

EPISODE_COLS = ("episode_start", "episode_end", "last_alert", "alert_count")


def local_runs(
    alerts: DataFrame, ttl: str = "90 seconds", alert_time: str = "window_end",
    keys: Sequence[str] = ("tower_id",), bucket: str = "1 day",
) -> DataFrame:
    """Runs inside (key, bucket): ``_first``, ``_last`` (epoch micros), ``_n`` rows, and ``_border`` for the
    first and last run of a bucket (at most two)."""
    ttl_us, bucket_us = duration_us(ttl), duration_us(bucket)
    tcol, ntz = as_time(alerts, alert_time)   # wall-clock input: gaps measured without any time zone
    rows = (alerts.filter(tcol.isNotNull())
            .select(*keys, to_epoch_us(tcol, ntz).alias("_t"))
            .withColumn("_b", F.expr(f"(_t - pmod(_t, {bucket_us})) div {bucket_us}"))  # exact floor
            .groupBy(*keys, "_b", "_t").agg(F.count(F.lit(1)).alias("_c")))   # equal times are one row, summed before the shuffle
    part = Window.partitionBy(*keys, "_b")
    starts = F.when(F.col("_t") - F.lag("_t").over(part.orderBy("_t")) > ttl_us, 1).otherwise(0)
    staged = rows.withColumn("_start", starts)
    staged = staged.withColumn("_run", F.sum("_start").over(
        part.orderBy("_t").rowsBetween(Window.unboundedPreceding, 0)))
    runs = staged.groupBy(*keys, "_b", "_run").agg(F.min("_t").alias("_first"), F.max("_t").alias("_last"),
                                                    F.sum("_c").alias("_n"))
    return runs.withColumn("_border", (F.col("_run") == 0) | (F.col("_run") == F.max("_run").over(part)))


def red_episodes(
    alerts: DataFrame,
    ttl: str = "90 seconds",
    alert_time: str = "window_end",
    keys: Sequence[str] = ("tower_id",),
    bucket: str = "1 day",
) -> DataFrame:
    ttl_us, keys = duration_us(ttl), list(keys)
    _, ntz = as_time(alerts, alert_time)
    runs = local_runs(alerts, ttl, alert_time, keys, bucket)
    per_key = Window.partitionBy(*keys).orderBy("_first")
    border = runs.filter("_border")
    border = border.withColumn("_new", F.when(F.col("_first") - F.lag("_last").over(per_key) <= ttl_us, 0).otherwise(1))
    joined = (border.withColumn("_island", F.sum("_new").over(per_key.rowsBetween(Window.unboundedPreceding, 0)))
              .groupBy(*keys, "_island").agg(F.min("_first").alias("_first"), F.max("_last").alias("_last"),
                                             F.sum("_n").alias("_n")))
    cols = [*keys, "_first", "_last", "_n"]
    return joined.select(*cols).unionByName(runs.filter("NOT _border").select(*cols)).select(
        *keys, from_epoch_us(F.col("_first"), ntz).alias("episode_start"),
        from_epoch_us(F.col("_last") + F.lit(ttl_us), ntz).alias("episode_end"),
        from_epoch_us(F.col("_last"), ntz).alias("last_alert"), F.col("_n").alias("alert_count"))


def red_episodes_stream(
    alerts: DataFrame,
    ttl: str = "90 seconds",
    alert_time: str = "window_end",
    keys: Sequence[str] = ("tower_id",),
    watermark: str | None = "10 seconds",
) -> DataFrame:
    """Streaming twin: ``session_window(alert_time, ttl)`` per key, append
    mode (an episode is emitted once the watermark passes its end). Event
    time must be TIMESTAMP (Spark's watermark rejects TIMESTAMP_NTZ). With
    ``spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition``
    (set in ``ENGINE_CONF``; the session's owner decides) sessions are merged
    inside each input partition first, so that a hot key sends a few sessions
    a task, not its rows."""
    require_instant(alerts, alert_time)
    df = alerts.withWatermark(alert_time, spark_duration(watermark, allow_zero=True)) if watermark else alerts
    return (df.groupBy(*keys, F.session_window(alert_time, spark_duration(ttl)).alias("_s"))
            .agg(F.min(alert_time).alias("episode_start"), F.max(alert_time).alias("last_alert"),
                 F.count(F.lit(1)).alias("alert_count"))
            .select(*keys, "episode_start", F.col("_s.end").alias("episode_end"), "last_alert", "alert_count"))


def status_changes(
    alerts: DataFrame,
    ttl: str = "90 seconds",
    alert_time: str = "window_end",
    keys: Sequence[str] = ("tower_id",),
    bucket: str = "1 day",
) -> DataFrame:
    """Explicit red/green events: ``red`` at each episode start, ``green``
    at its end (last alert + ttl). A projection of ``red_episodes``."""
    ep = red_episodes(alerts, ttl, alert_time, keys, bucket)
    ev = F.explode(F.array(
        F.struct(F.col("episode_start").alias("changed_at"), F.lit("red").alias("status")),
        F.struct(F.col("episode_end").alias("changed_at"), F.lit("green").alias("status")),
    ))
    return ep.select(*keys, ev.alias("_e")).select(*keys, "_e.changed_at", "_e.status")
