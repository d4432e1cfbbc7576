"""Message envelopes: ``(key binary, value binary, timestamp)`` frames as a
message bus delivers them, decoded to typed columns and encoded back.

Decoding is columnar and JVM-side: the first byte routes a row (``0x00`` =
schema-registry Avro framing, anything else = JSON text); JSON goes through
``from_json`` in PERMISSIVE mode with a corrupt-record column, and any row
that fails to decode is dropped (optionally kept on a rejected side output).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

CORRUPT = "_corrupt_record"
ENVELOPE = T.StructType([
    T.StructField("key", T.BinaryType(), True),
    T.StructField("value", T.BinaryType(), True),
    T.StructField("timestamp", T.TimestampType(), True),
])


def _avro_functions():
    try:
        from pyspark.sql.avro import functions as avro  # type: ignore
        return avro
    except Exception:  # noqa: BLE001
        return None


def _is_avro_framed(value: Column) -> Column:
    return F.hex(F.substring(value, 1, 1)) == F.lit("00")


def decode_envelope(
    env: DataFrame,
    schema: T.StructType,
    avro_schema: str | None = None,
    value_col: str = "value",
    carry: tuple[str, ...] = ("key", "timestamp"),
    with_rejected: bool = False,
    schema_id: int | None = None,
) -> DataFrame | tuple[DataFrame, DataFrame]:
    """Decode the value bytes into ``schema`` columns, carrying ``carry``.

    * NULL value -> dropped;
    * first byte 0x00 -> Avro with a 5-byte header (magic + schema id);
      needs ``avro_schema`` and the spark-avro package (checked up front,
      raising a clear error if missing); a body that fails to decode, or a
      header whose id differs from ``schema_id`` (when given), is rejected;
    * any record missing a required (non-nullable) field is rejected;
      without ``avro_schema`` such rows are rejected;
    * otherwise the bytes are UTF-8 JSON text decoded with ``from_json``;
      malformed text, a non-object, or values of the wrong type -> rejected.
      A time field is a number of epoch milliseconds (as the records declare)
      or ISO text; any other value in it -> rejected.

    Returns the decoded frame, or ``(decoded, rejected)`` with
    ``with_rejected=True`` (rejected rows keep the raw envelope).
    """
    avro = None
    if avro_schema is not None:
        avro = _avro_functions()
        require_avro(env.sparkSession, avro_schema)
    v = F.col(value_col)
    times = {f.name for f in schema.fields if isinstance(f.dataType, _TIMES)}
    json_schema = T.StructType([T.StructField(f.name, T.StringType(), f.nullable) if f.name in times else f
                                for f in schema.fields] + [T.StructField(CORRUPT, T.StringType(), True)])
    parsed_json = F.from_json(v.cast("string"), json_schema,
                              {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    if times:   # read times as text first, then as milliseconds or ISO; a text that is neither spoils the record
        env = env.withColumn("_json", parsed_json)
        j = F.col("_json")
        typed = {f.name: _time_of(j[f.name]).cast(f.dataType) for f in schema.fields if f.name in times}
        bad = F.lit(False)
        for n, c in typed.items():
            bad = bad | (j[n].isNotNull() & c.isNull())
        parsed_json = F.when(j.isNotNull(), F.struct(
            *[typed.get(f.name, j[f.name]).alias(f.name) for f in schema.fields],
            F.when(bad, F.lit("time field")).otherwise(j[CORRUPT]).alias(CORRUPT)))
    framed = _is_avro_framed(v)
    if avro is not None:
        # decode each framed body once, in its own column; a body that fails to
        # decode (PERMISSIVE gives NULL or an all-NULL record) or carries another
        # schema id is marked corrupt and rejected below
        env = env.withColumn("_avro", F.when(framed, avro.from_avro(
            F.expr(f"substring({value_col}, 6)"), avro_schema, {"mode": "PERMISSIVE"})))
        a = F.col("_avro")
        ok_avro = a.isNotNull()
        if not any(not f.nullable for f in schema.fields):
            # PERMISSIVE decoding turns a corrupt body into an all-NULL record:
            # without required fields, at least one field must be set
            ok_avro = ok_avro & F.greatest(*[a[f.name].isNotNull() for f in schema.fields], F.lit(False))
        if schema_id is not None:
            ok_avro = ok_avro & (F.hex(F.substring(v, 2, 4)) == F.lit(format(int(schema_id), "08X")))
        decoded = F.when(framed, F.struct(
            *[a[f.name].alias(f.name) for f in schema.fields],
            F.when(~ok_avro, F.lit("avro decode failed")).alias(CORRUPT))).otherwise(parsed_json)
    else:
        decoded = parsed_json
    carried = [c for c in carry if c in env.columns]
    # Parse once: the decoded struct is materialised in its own projection and
    # invalid rows are dropped by a generator (zero or one row per input).
    # A plain filter would be pushed below the projection with the parse
    # inlined into its condition, decoding every value two or three times.
    raw_cols = [c for c in env.columns if c not in ("_avro", "_json")]
    staged = env.select(*carried, *[c for c in raw_cols if c not in carried],
                        decoded.alias("_decoded"), framed.alias("_framed"))
    d = F.col("_decoded")
    valid = v.isNotNull() & d.isNotNull() & d[CORRUPT].isNull()
    for f in schema.fields:   # a record must carry every required field, whatever its encoding
        if not f.nullable:
            valid = valid & d[f.name].isNotNull()
    if avro is None:
        valid = valid & ~F.col("_framed")
    valid = F.coalesce(valid, F.lit(False))
    row = F.struct(*[d[f.name].alias(f.name) for f in schema.fields])
    good = staged.select(*carried, F.inline(F.when(valid, F.array(row))))
    if not with_rejected:
        return good
    # the rejected side uses the same generator, so the parse is not re-run in a filter
    bad = staged.select(F.inline(F.when(~valid, F.array(F.struct(*[F.col(c) for c in raw_cols])))))
    return good, bad


_TIMES = (T.TimestampType, T.TimestampNTZType)


def _time_of(text: Column) -> Column:
    """Epoch milliseconds or ISO text as a timestamp; anything else is NULL."""
    digits = text.rlike("^-?[0-9]{1,15}$")
    return F.when(digits, F.timestamp_millis(F.when(digits, text).cast("long"))).otherwise(text.try_cast("timestamp"))


def require_avro(spark, avro_schema: str) -> None:
    """Raise unless this session can decode Avro with the given schema (the
    function is tried on an empty frame, however its package was loaded)."""
    avro = _avro_functions()
    try:
        if avro is None:
            raise RuntimeError("no Avro functions in this PySpark")
        spark.createDataFrame([], "value binary").select(avro.from_avro("value", avro_schema)).schema  # noqa: B018
    except Exception as exc:
        raise RuntimeError("Avro envelopes need the spark-avro package on the classpath "
                           "(spark.jars.packages=org.apache.spark:spark-avro_2.13:<version>) "
                           f"and a valid schema: {str(exc)[:200]}") from exc


def encode_envelope(df: DataFrame, key: str | None = "tower_id", time_col: str | None = None,
                    fields: list[str] | None = None, avro_schema: str | None = None,
                    schema_id: int | None = None, time_format: str = "millis") -> DataFrame:
    """Typed rows -> ``(key, value, timestamp)``.

    The value is JSON text (``to_json``) with times as epoch milliseconds, the
    records' declared type (``time_format="iso"``: ISO text with microseconds), or, with ``avro_schema`` and
    ``schema_id``, registry-framed Avro (magic byte 0x00, 4-byte big-endian
    schema id, ``to_avro`` body; needs spark-avro). The key column is the
    partitioning key on the bus (same key, same partition). Both encodings
    stay in the JVM.
    """
    cols = fields or df.columns
    body = F.struct(*[F.col(c) for c in cols])
    if avro_schema is not None:
        avro = _avro_functions()
        if schema_id is None:
            raise RuntimeError("Avro envelopes need a schema id")
        require_avro(df.sparkSession, avro_schema)
        header = F.unhex(F.lit("00" + format(int(schema_id), "08x")))
        value = F.concat(header, avro.to_avro(body, avro_schema))
    else:
        if time_format not in ("millis", "iso"):
            raise ValueError("time_format must be 'millis' or 'iso'")
        if time_format == "millis":
            times = {f.name for f in df.schema.fields if isinstance(f.dataType, _TIMES)}
            body = F.struct(*[F.unix_millis(F.col(c).cast("timestamp")).alias(c) if c in times else F.col(c) for c in cols])
        value = F.to_json(body, {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
                                 "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}).cast("binary")
    out = [F.col(key).cast("binary").alias("key") if key else F.lit(None).cast("binary").alias("key"),
           value.alias("value")]
    if time_col:
        out.append(F.col(time_col).cast("timestamp").alias("timestamp"))
    return df.select(*out)
