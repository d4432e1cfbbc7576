"""Topics: append-only tables of keyed records, read and written as streams
or as batch tables.

A ``Topic`` is either bus-backed (Kafka: records travel as ``key``/``value``
bytes and are decoded with the record schema) or file-backed (a parquet
folder written by a streaming file sink: typed columns with the ``key``
first, exactly-once across restarts). Both give the same frame shape:
``key`` plus the record's fields, in schema order; a bus topic with
``time_col`` adds the message time under that name. A bus topic with
``avro_schema`` reads and writes registry-framed Avro; without the package
it fails when the query is built, and never drops such records silently.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from pylonflow.schemas import conform
from pylonflow.session import checkpoint_root, scratch_path
from pylonflow.sources.envelope import decode_envelope, encode_envelope, require_avro


@dataclass(frozen=True)
class Topic:
    name: str
    schema: T.StructType
    key: str = "tower_id"
    path: str | None = None               # file-backed topic folder
    bootstrap_servers: str | None = None  # bus-backed topic
    partitions: int = 3
    avro_schema: str | None = None        # registry-framed Avro values (else JSON text)
    schema_id: int | None = None
    time_col: str | None = None           # column that receives a bus message's own time

    @property
    def is_bus(self) -> bool:
        return self.bootstrap_servers is not None

    def file_schema(self) -> T.StructType:
        return T.StructType([T.StructField("key", T.BinaryType(), True), *self.schema.fields])


def file_topic(spark: SparkSession, name: str, schema: T.StructType, key: str = "tower_id") -> Topic:
    """A file-backed topic under the shared checkpoint root."""
    return Topic(name, schema, key, path=scratch_path(spark, "topics", name))


def consumer_checkpoint(spark: SparkSession, consumer: str, on_restart: str = "resume") -> tuple[str, str]:
    """Checkpoint folder and start position for a named consumer.

    A consumer's checkpoints are numbered generations, recorded in a small
    table next to them. ``resume`` (default) continues the newest one;
    ``skip`` opens the next, which starts at the tail (``latest``) and drops
    the backlog, as a redeploy that must not replay would. A later
    ``resume`` continues that generation, so what was skipped stays skipped.
    """
    if on_restart not in ("resume", "skip"):
        raise ValueError("on_restart must be 'resume' or 'skip'")
    root = f"{checkpoint_root(spark)}/pylonflow/consumers/{consumer}"
    record = T.StructType([T.StructField("generation", T.LongType()), T.StructField("start", T.StringType())])
    try:
        known = spark.read.schema(record).parquet(f"{root}/generations").orderBy(F.col("generation").desc()).first()
    except AnalysisException as exc:
        if (exc.getCondition() or "") != "PATH_NOT_FOUND":
            raise
        known = None
    if known is None or on_restart == "skip":
        known = (0 if known is None else known["generation"] + 1, "latest" if on_restart == "skip" else "earliest")
        spark.createDataFrame([known], record).coalesce(1).write.mode("append").parquet(f"{root}/generations")
    return f"{root}/checkpoint-{known[0]}", known[1]


def read_topic(spark: SparkSession, topic: Topic, start: str = "earliest", streaming: bool = True,
               max_per_trigger: int | None = None) -> DataFrame:
    """Records of ``topic`` as ``key`` + schema columns (stream or batch).

    File-backed topics are read through the sink's commit log, so only
    committed files are seen. ``start`` applies to bus topics; a file stream
    can only start at the beginning of its folder, so any other start raises.
    """
    if not topic.is_bus and start != "earliest":
        raise ValueError(f"file-backed topic {topic.name!r} starts at 'earliest' only, not {start!r}")
    if topic.is_bus:
        if topic.avro_schema is not None:
            require_avro(spark, topic.avro_schema)
        reader = spark.readStream if streaming else spark.read
        r = (reader.format("kafka").option("subscribe", topic.name)
             .option("kafka.bootstrap.servers", topic.bootstrap_servers)
             .option("startingOffsets", start))
        if max_per_trigger and streaming:
            r = r.option("maxOffsetsPerTrigger", str(max_per_trigger))
        return decode_topic(r.load().select("key", "value", "timestamp"), topic)
    if streaming:
        r = spark.readStream.schema(topic.file_schema())
        if max_per_trigger:
            r = r.option("maxFilesPerTrigger", str(max_per_trigger))
        return r.parquet(topic.path)
    return spark.read.schema(topic.file_schema()).parquet(topic.path)


def decode_topic(env: DataFrame, topic: Topic) -> DataFrame:
    """``(key, value, timestamp)`` messages of a bus topic as its records."""
    carry = ("key", "timestamp") if topic.time_col else ("key",)
    rows = decode_envelope(env, topic.schema, avro_schema=topic.avro_schema, schema_id=topic.schema_id, carry=carry)
    return rows.withColumnRenamed("timestamp", topic.time_col) if topic.time_col else rows


def write_topic(df: DataFrame, topic: Topic, checkpoint: str, available_now: bool = False,
                trigger: str = "2 seconds", keyed_partitions: bool = False) -> StreamingQuery:
    """Append a stream to ``topic``: records conformed to the topic schema
    (exact columns, defaults, typed NULLs) with the key first.

    Bus topics hash the key to a partition; for file topics
    ``keyed_partitions=True`` co-locates each key in one of
    ``topic.partitions`` files per micro-batch.
    """
    records = conform(df, topic.schema, key=topic.key, allow_extra=True)
    if topic.is_bus:
        out = encode_envelope(records.drop("key"), key=topic.key, avro_schema=topic.avro_schema,
                              schema_id=topic.schema_id).select("key", "value")
        w = (out.writeStream.format("kafka").option("topic", topic.name)
             .option("kafka.bootstrap.servers", topic.bootstrap_servers))
    else:
        if keyed_partitions:
            records = records.repartition(topic.partitions, F.col("key"))
        w = records.writeStream.format("parquet").option("path", topic.path)
    w = w.outputMode("append").option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=trigger)
    return w.start()
