"""Late rows: counted by the row, and kept.

``late_row_writer`` is a ``foreachBatch`` body for the stream that feeds an aggregation. The watermark of a batch is the
newest event time of all batches before it, less ``delay``, as Spark's is; a row is late when the end of its window is
not after it. The late rows go into an ``EventTable``; how many there were, and the newest event time, come from the
same pass over the batch as observed metrics and are carried to the next batch in one small row.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pylonflow.functions.timeutil import duration_us
from pylonflow.streaming.retained import CarriedTable, EventTable

BEFORE_ALL = -(1 << 62)     # a comparison, not the constant false, under which the plan would lose its metrics
SEEN = T.StructType([T.StructField(c, T.LongType()) for c in ("newest_us", "rows", "late")])


def _seen(path: str) -> CarriedTable:
    return CarriedTable(f"{path}/seen", SEEN)


def late_table(path: str, schema: T.StructType, time_col: str = "event_time", keep: str | None = None) -> EventTable:
    return EventTable(f"{path}/rows", schema, time_col, keep)


def late_row_writer(path: str, time_col: str = "event_time", window: str = "60 seconds", delay: str = "10 seconds",
                    keep: str | None = None) -> Callable[[DataFrame, int], None]:
    width, wait = duration_us(window), duration_us(delay)

    def body(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        before = _seen(path).version(spark, batch_id - 1).first()
        if before is None and batch_id > 0:
            raise ValueError(f"batch {batch_id - 1} left no count under {path}")
        newest, rows, late = before or (None, 0, 0)
        t = F.unix_micros(F.col(time_col))
        end = t - F.pmod(t, F.lit(width)) + width
        limit = newest - wait if newest is not None else BEFORE_ALL
        is_late = F.coalesce(end <= limit, F.lit(False))
        seen = Observation()
        marked = batch.withColumn("_late", is_late).observe(
            seen, F.count("*").alias("rows"), F.count(F.when(F.col("_late"), 1)).alias("late"), F.max(t).alias("newest_us"))
        table = late_table(path, batch.schema, time_col, keep)
        table.write(marked.where("_late").drop("_late"), batch_id)
        got = seen.get
        found = [x for x in (newest, got["newest_us"]) if x is not None]
        _seen(path).write(spark.createDataFrame([(max(found, default=None), rows + got["rows"], late + got["late"])], SEEN), batch_id)

    return body


def count_late_rows(spark: SparkSession, path: str) -> int:
    row = _seen(path).current(spark).first()
    return 0 if row is None else row["late"]


def read_late_rows(spark: SparkSession, path: str, schema: T.StructType, time_col: str = "event_time") -> DataFrame:
    """The late rows themselves."""
    return late_table(path, schema, time_col).read(spark)
