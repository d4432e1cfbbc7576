"""Record schemas of the three streams, and the sink contract ``conform``.

The schemas are explicit ``StructType`` constants (never inferred). Field
order is the sink order: sinks match positionally with an exact column count.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_S, _D, _L, _B, _TS = T.StringType(), T.DoubleType(), T.LongType(), T.BooleanType(), T.TimestampType()

TELEMETRY = T.StructType([
    T.StructField("tower_id", _S, False),
    T.StructField("tower_name", _S, False),
    T.StructField("latitude", _D, False),
    T.StructField("longitude", _D, False),
    T.StructField("temperature", _D, False),
    T.StructField("signal_strength", _D, False),
    T.StructField("cpu_load", _D, False),
    T.StructField("event_time", _TS, False),
    T.StructField("is_anomaly", _B, False),
])

ALERT = T.StructType([
    T.StructField("tower_id", _S, False),
    T.StructField("tower_name", _S, False),
    T.StructField("latitude", _D, False),
    T.StructField("longitude", _D, False),
    T.StructField("avg_temperature", _D, False),
    T.StructField("avg_signal", _D, False),
    T.StructField("max_temperature", _D, False),
    T.StructField("min_signal", _D, False),
    T.StructField("event_count", _L, False),
    T.StructField("window_start", _TS, False),
    T.StructField("window_end", _TS, False),
])

PARSED_FIELDS = ("severity_level", "diagnosis", "immediate_actions", "escalation", "ticket_priority")

RESPONSE = T.StructType([
    T.StructField("tower_id", _S, False),
    T.StructField("tower_name", _S, False),
    T.StructField("window_start", _TS, False),
    T.StructField("window_end", _TS, False),
    T.StructField("avg_temperature", _D, False),
    T.StructField("avg_signal", _D, False),
    T.StructField("max_temperature", _D, False),
    T.StructField("min_signal", _D, False),
    T.StructField("event_count", _L, False),
    T.StructField("agent_response", _S, False),
    *[T.StructField(f, _S, True) for f in PARSED_FIELDS],
    T.StructField("processed_at", _TS, False),
])

# Record defaults declared by the registered schemas.
DEFAULTS: Mapping[str, Mapping[str, object]] = {
    "telemetry": {},
    "alert": {"tower_name": "", "latitude": 0.0, "longitude": 0.0},
    "response": {"tower_name": "", **{f: None for f in PARSED_FIELDS}},
}

_DEFAULTS_BY_SCHEMA = ((TELEMETRY, DEFAULTS["telemetry"]), (ALERT, DEFAULTS["alert"]),
                       (RESPONSE, DEFAULTS["response"]))


class SchemaMismatch(ValueError):
    """Raised when a frame cannot be conformed to a sink schema."""


def conform(
    df: DataFrame,
    schema: T.StructType,
    defaults: Mapping[str, object] | None = None,
    key: str | Column | None = None,
    allow_extra: bool = False,
) -> DataFrame:
    """Project ``df`` onto ``schema``: exact column set and order, exact types.

    * a present column is cast to the declared type;
    * a missing column takes its declared default (``defaults``, or the
      record default of a known schema); a missing nullable column without a
      default becomes a typed NULL;
    * a missing required column without a default raises ``SchemaMismatch``;
    * an unknown extra column raises unless ``allow_extra``;
    * ``key`` (a column name or expression) adds a leading binary ``key``.

    This is a pure projection: no shuffle, runs on streams unchanged.
    """
    if defaults is None:
        defaults = next((d for known, d in _DEFAULTS_BY_SCHEMA if known == schema), {})
    present = set(df.columns)
    wanted = [f.name for f in schema.fields]
    extra = present - set(wanted) - ({key} if isinstance(key, str) else set())
    if extra and not allow_extra:
        raise SchemaMismatch(f"columns not in the sink schema: {sorted(extra)}")
    cols: list[Column] = []
    if key is not None:
        kcol = F.col(key) if isinstance(key, str) else key
        cols.append(kcol.cast("binary").alias("key"))
    for f in schema.fields:
        if f.name in present:
            c = F.col(f.name)
            if f.name in defaults and defaults[f.name] is not None:
                c = F.coalesce(c, F.lit(defaults[f.name]))
            cols.append(c.cast(f.dataType).alias(f.name))
        elif f.name in defaults:
            cols.append(F.lit(defaults[f.name]).cast(f.dataType).alias(f.name))
        elif f.nullable:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
        else:
            raise SchemaMismatch(f"required column {f.name!r} is missing and has no default")
    return df.select(*cols)


# --- registered record schemas (Avro JSON) -> Spark types ---------------------

_AVRO_PRIMITIVES = {
    "string": T.StringType(), "double": T.DoubleType(), "float": T.FloatType(), "long": T.LongType(),
    "int": T.IntegerType(), "boolean": T.BooleanType(), "bytes": T.BinaryType(),
}
_AVRO_LOGICAL = {
    "timestamp-millis": T.TimestampType(), "timestamp-micros": T.TimestampType(),
    "local-timestamp-millis": T.TimestampNTZType(), "local-timestamp-micros": T.TimestampNTZType(),
    "date": T.DateType(),
}


def _avro_type(t) -> tuple[T.DataType, bool]:
    """(Spark type, nullable) of one Avro field type."""
    if isinstance(t, list):
        branches = [b for b in t if b != "null"]
        if len(branches) != 1:
            raise ValueError(f"only [null, T] unions are supported, got {t}")
        return _avro_type(branches[0])[0], "null" in t
    if isinstance(t, dict):
        if t.get("logicalType") in _AVRO_LOGICAL:
            return _AVRO_LOGICAL[t["logicalType"]], False
        if t.get("type") in _AVRO_PRIMITIVES:
            return _AVRO_PRIMITIVES[t["type"]], False
        raise ValueError(f"unsupported Avro type {t}")
    if t in _AVRO_PRIMITIVES:
        return _AVRO_PRIMITIVES[t], False
    raise ValueError(f"unsupported Avro type {t!r}")


def struct_from_avro(record) -> tuple[T.StructType, dict]:
    """A flat Avro record schema (JSON text or dict) -> (StructType, defaults).

    What a schema-registry lookup gives a catalog: column names, types and
    nullability in field order, plus the declared defaults that ``conform``
    applies to missing columns.
    """
    import json
    rec = json.loads(record) if isinstance(record, str) else record
    if rec.get("type") != "record":
        raise ValueError("expected an Avro record schema")
    fields, defaults = [], {}
    for f in rec["fields"]:
        dtype, nullable = _avro_type(f["type"])
        fields.append(T.StructField(f["name"], dtype, nullable))
        if "default" in f:
            defaults[f["name"]] = _avro_default(f["type"], f["default"])
    return T.StructType(fields), defaults


def _avro_default(t, value):
    """Avro JSON default -> Python value of the Spark type (logical types are
    encoded as numbers in Avro: epoch millis/micros, days)."""
    import datetime as _dt
    if value is None:
        return None
    if isinstance(t, list):  # [T, "null"] / ["null", T]: the default belongs to the first branch
        t = t[0]
    logical = t.get("logicalType") if isinstance(t, dict) else None
    utc = _dt.datetime(1970, 1, 1, tzinfo=_dt.timezone.utc)   # instants
    local = _dt.datetime(1970, 1, 1)                             # wall-clock (NTZ)
    if logical == "timestamp-millis":
        return utc + _dt.timedelta(milliseconds=value)
    if logical == "timestamp-micros":
        return utc + _dt.timedelta(microseconds=value)
    if logical == "local-timestamp-millis":
        return local + _dt.timedelta(milliseconds=value)
    if logical == "local-timestamp-micros":
        return local + _dt.timedelta(microseconds=value)
    if logical == "date":
        return _dt.date(1970, 1, 1) + _dt.timedelta(days=value)
    return value
