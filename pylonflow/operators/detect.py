"""Alert detection: threshold filter + tumbling event-time window aggregate."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pylonflow.functions.predicates import ANOMALY_RULES, Rule, any_of
from pylonflow.functions.timeutil import require_instant, spark_duration

TOWER_KEYS = ("tower_id", "tower_name", "latitude", "longitude")
# (output column, aggregate, input column); COUNT(*) is always appended as event_count.
ALERT_METRICS = (
    ("avg_temperature", "avg", "temperature"),
    ("avg_signal", "avg", "signal_strength"),
    ("max_temperature", "max", "temperature"),
    ("min_signal", "min", "signal_strength"),
)
EXACT_DIGITS = 6


def exact_avg(c: Column, digits: int = EXACT_DIGITS) -> Column:
    """Average that does not depend on the order of the rows: batch, stream and any partitioning agree in the last bit.

    Values count as whole multiples of ``10**-digits``; their sum is a whole number, and one division rounds once. NULLs
    are left out, no value gives NULL, and a sum beyond 64 bits is an error.
    """
    unit = F.round(c.cast("double") * F.lit(float(10 ** digits))).cast("long")
    n = F.count(unit)
    return F.when(n > 0, F.sum(unit).cast("double") / (F.greatest(n, F.lit(1)).cast("double") * F.lit(float(10 ** digits))))


# The same metrics with averages that any order of the rows gives alike.
EXACT_METRICS = tuple((name, "exact_avg" if agg == "avg" else agg, col) for name, agg, col in ALERT_METRICS)
_AGGS = {"avg": F.avg, "exact_avg": exact_avg, "max": F.max, "min": F.min, "sum": F.sum, "count": F.count}


def _metric(name: str, agg: str, col: str) -> Column:
    if agg not in _AGGS:
        raise ValueError(f"unsupported aggregate {agg!r}")
    return _AGGS[agg](F.col(col)).alias(name)


def detect_alerts(
    telemetry: DataFrame,
    rules: Sequence[Rule | tuple] = ANOMALY_RULES,
    window: str = "60 seconds",
    keys: Sequence[str] = TOWER_KEYS,
    metrics: Sequence[tuple[str, str, str]] = ALERT_METRICS,
    time_col: str = "event_time",
    watermark: str | None = None,
    count_col: str = "event_count",
) -> DataFrame:
    """One row per (keys, tumbling window) that holds at least one breaching row.

    Windows are epoch-aligned, start inclusive / end exclusive; empty windows
    emit nothing. The grouping carries constant per-key attributes (name,
    coordinates) instead of joining them back; a changed attribute splits the
    group. Physically: filter + partial HashAggregate before the exchange on
    the keys, final HashAggregate after it, so a hot key is pre-combined on
    the map side and its windows spread over reducers.

    With ``watermark`` set it runs as a stream in append mode: a window is
    emitted once, after the watermark passes its end. Every reading must
    advance event time (a run of normal readings closes the open window), but
    Spark pushes a plain filter below ``withWatermark``, which would let only
    breaching rows move the watermark. So the streaming form aggregates all
    readings with conditional aggregates (``avg(when(breach, x))``,
    ``count(when(breach, 1))``) and drops groups without a breach afterwards.
    Same results; the state holds one entry per active key and open window.
    """
    win = F.window(time_col, spark_duration(window)).alias("_w")
    if watermark is not None:
        require_instant(telemetry, time_col)
    if watermark is None:
        grouped = (telemetry.filter(any_of(rules))
                   .groupBy(*keys, win)
                   .agg(*[_metric(*m) for m in metrics], F.count(F.lit(1)).alias(count_col)))
    else:
        breach = any_of(rules)
        grouped = (telemetry.withWatermark(time_col, spark_duration(watermark, allow_zero=True))
                   .groupBy(*keys, win)
                   .agg(*[_AGGS[a](F.when(breach, F.col(c))).alias(n) for n, a, c in metrics],
                        F.count(F.when(breach, F.lit(1))).alias(count_col))
                   .filter(F.col(count_col) > 0))
    return grouped.select(*keys, *[m[0] for m in metrics], count_col,
                          F.col("_w.start").alias("window_start"), F.col("_w.end").alias("window_end"))
