"""Telemetry readings from the ``events`` table's own columns.

A pure projection (no join, no shuffle), the same on a batch table and on a
stream. Every field is read off a column: the tower from ``user_id`` (users
are unevenly spread: the last tower holds most of them), its name from
``event_type``, the time from ``ts`` (the month is mapped onto an hour, at the
record's millisecond precision), the temperature from ``value``, signal and
load from ``props``. Sign-ups carry no temperature, and rows without a
readable ``props.k`` neither signal nor load: those are NULL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

COLUMNS = ("ts", "user_id", "event_type", "value", "props")
TOWERS = 16            # towers 0 .. 15; user ids fold onto 64 slots, slots beyond the last tower onto it
SLOTS = 64
START_MS = 1704067200000
TIME_FOLD = 720        # event time runs so many times faster than ts


def readings(events: DataFrame) -> DataFrame:
    """One TELEMETRY row per event."""
    base = events.selectExpr(
        f"least(pmod(user_id, {SLOTS}), {TOWERS - 1}) AS _tower", "event_type AS tower_name",
        f"timestamp_millis({START_MS} + (unix_millis(CAST(ts AS TIMESTAMP)) - {START_MS}) div {TIME_FOLD}) AS event_time",
        "CASE WHEN event_type <> 'signup' THEN 40D + value / 5D END AS temperature",
        "CAST(get_json_object(props, '$.k') AS BIGINT) AS _k")
    base = base.selectExpr("*", "-62D - 0.32D * _k AS signal_strength")
    return base.selectExpr(
        "concat('T', lpad(CAST(_tower AS STRING), 2, '0')) AS tower_id", "tower_name",
        "CAST(_tower AS DOUBLE) AS latitude", "CAST(-_tower AS DOUBLE) AS longitude",
        "temperature", "signal_strength", "CAST(_k AS DOUBLE) AS cpu_load", "event_time",
        "coalesce(temperature > 85D, false) OR coalesce(signal_strength < -90D, false) AS is_anomaly")
