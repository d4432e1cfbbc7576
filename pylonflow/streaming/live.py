"""Live views: the state of a running query, read as a table.

A view such as the latest reading per tower is a streaming aggregate, and its state store already holds the answer: one
row per key, committed with every micro-batch, compacted and cleaned up by Spark. ``start_view`` runs the aggregate for
its state alone; ``read_view`` reads the state of the last committed batch with Spark's ``statestore`` source. A read
costs the number of keys, whatever the history, and works while the query runs, after it stopped, and from other
sessions.

``feed_writer`` keeps the first ``n`` rows of a feed (newest first) and tells which rows each micro-batch brought into it.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from pylonflow.operators.views import alert_feed
from pylonflow.streaming.retained import BATCH, CarriedTable


def start_view(view: DataFrame, checkpoint: str, available_now: bool = False, trigger: str = "2 seconds") -> StreamingQuery:
    """Run a streaming aggregate for its state: what changes is not written anywhere else."""
    w = view.writeStream.outputMode("update").format("noop").option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=trigger)
    return w.start()


def read_view(spark: SparkSession, checkpoint: str, schema: T.StructType, keys: Sequence[str]) -> DataFrame:
    """Rows of ``schema`` (the aggregate's: its keys and values) at the last committed micro-batch.

    The aggregate has one ``max_by`` of a struct whose fields are the values (as ``latest_by_key``), or one plain
    buffer per value (``max``, ``min``, ``sum``, ``count``), in order. Without a committed batch the view is empty.
    """
    try:
        state = spark.read.format("statestore").load(checkpoint)
    except PySparkException as exc:
        if (exc.getCondition() or "") != "STDS_COMMITTED_BATCH_UNAVAILABLE":
            raise
        return spark.createDataFrame([], schema)
    values = [f for f in schema.fields if f.name not in keys]
    buffers = state.schema["value"].dataType.fields
    first = buffers[0].dataType
    if isinstance(first, T.StructType) and first.fieldNames() == [f.name for f in values]:
        found = [F.col(f"value.`{buffers[0].name}`.`{f.name}`") for f in values]
    elif len(buffers) == len(values):
        found = [F.col(f"value.`{b.name}`") for b in buffers]
    else:
        raise ValueError(f"the state holds {[b.name for b in buffers]}, not the values {[f.name for f in values]}")
    by_name = {f.name: c.cast(f.dataType).alias(f.name) for f, c in zip(values, found, strict=True)}
    by_name |= {k: F.col(f"key.`{k}`").alias(k) for k in keys}
    return state.select(*[by_name[f.name] for f in schema.fields])


def run_view(view: DataFrame, checkpoint: str, keys: Sequence[str]) -> DataFrame:
    """Take in what is there now, then read the view."""
    start_view(view, checkpoint, available_now=True).awaitTermination()
    return read_view(view.sparkSession, checkpoint, view.schema, keys)


def feed_tables(path: str, schema: T.StructType) -> tuple[CarriedTable, CarriedTable]:
    """The feed as it stands, and the rows that the last batch brought into it."""
    return CarriedTable(f"{path}/feed", schema), CarriedTable(f"{path}/news", schema)


def feed_writer(path: str, schema: T.StructType, limit: int, time_col: str = "window_end",
                emit: Callable[[DataFrame, int], None] | None = None) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` body of a live feed: the first ``limit`` rows, newest first.

    The feed of the batch before and the new rows are ordered together (each partition keeps its own first rows), so
    the state is ``limit`` rows however long the stream. ``emit`` gets the rows that came into the feed, oldest first,
    and the batch's number; a replayed batch brings the same rows again.
    """
    feed, news = feed_tables(path, schema)

    def body(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        before = feed.version(spark, batch_id - 1).withColumn(BATCH, F.lit(-1).cast("long"))
        both = before.unionByName(batch.select(*schema.fieldNames()).withColumn(BATCH, F.lit(batch_id).cast("long")))
        first = alert_feed(both, limit, time_col).persist()     # ``limit`` rows; whether a row is new comes last in its order
        try:
            feed.write(first, batch_id)
            news.write(first.where(F.col(BATCH) == batch_id), batch_id)
        finally:
            first.unpersist()
        if emit is not None:
            emit(news.version(spark, batch_id).orderBy(F.col(time_col).asc()), batch_id)

    return body


def read_feed(spark: SparkSession, path: str, schema: T.StructType, time_col: str = "window_end") -> DataFrame:
    """The feed as the last batch left it, newest first."""
    return alert_feed(feed_tables(path, schema)[0].current(spark), None, time_col)
