"""Durable tables of a flow: appended by micro-batch, kept for a time, read by partition.

An ``EventTable`` is a parquet folder partitioned by the hour of the rows' event time and by the micro-batch that wrote
them. Each micro-batch overwrites its own partitions (dynamic partition overwrite), so that a replayed batch leaves every
row once. With ``keep`` the table drops whole hours that lie behind the newest event time less ``keep``, as a topic with
a retention time does: by overwriting the hour with nothing, while streams go on reading the other hours. Readers ask
for the hours they need and list no others.

A ``CarriedTable`` is a small table that each micro-batch makes anew from the one before it: three folders in turn, so
that a replay finds its predecessor and a reader a whole version, and nothing is ever listed or piled up.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pylonflow.functions.timeutil import duration_us

HOUR, BATCH = "event_hour", "batch"
HOUR_FORMAT = "yyyy-MM-dd-HH"
PARTS = T.StructType([T.StructField(HOUR, T.StringType()), T.StructField(BATCH, T.LongType())])


def is_missing_table(exc: AnalysisException) -> bool:
    return (exc.getCondition() or "") in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


def hour_of(time_col: str):
    return F.date_format(F.col(time_col), HOUR_FORMAT)


@dataclass(frozen=True)
class EventTable:
    """``path`` holds rows of ``schema``; ``time_col`` is their event time, ``keep`` (``"8 hours"``) how long they stay.

    Rows without event time have a partition of their own and stay. A row leaves at the latest an hour after ``keep``.
    """

    path: str
    schema: T.StructType
    time_col: str
    keep: str | None = None

    def _reader(self, spark: SparkSession, streaming: bool = False):
        reader = spark.readStream if streaming else spark.read
        return reader.schema(T.StructType([*self.schema.fields, *PARTS.fields])).option("ignoreMissingFiles", "true").option("basePath", self.path)

    def create(self, spark: SparkSession) -> None:
        """Make an empty table where there is none, so that its readers can start first."""
        try:
            spark.read.schema(self.schema).parquet(self.path)
        except AnalysisException as exc:
            if not is_missing_table(exc):
                raise
            spark.createDataFrame([], T.StructType([*self.schema.fields, *PARTS.fields])).write.mode("append").partitionBy(HOUR, BATCH).parquet(self.path)

    def read(self, spark: SparkSession, hours: Iterable[str] | None = None, parts: bool = False) -> DataFrame:
        """The table, or its rows of some ``hours`` (only those folders are listed); ``parts`` keeps the partition columns."""
        wanted = None if hours is None else sorted(h if h is not None else "__HIVE_DEFAULT_PARTITION__" for h in set(hours))
        where = self.path if wanted is None else f"{self.path}/{HOUR}={{{','.join(wanted)}}}"
        full = [*self.schema.fieldNames(), *(PARTS.fieldNames() if parts else [])]
        if wanted == []:
            return self._empty(spark, full)
        try:
            return self._reader(spark).parquet(where).select(*full)
        except AnalysisException as exc:
            if not is_missing_table(exc):
                raise
            return self._empty(spark, full)

    def _empty(self, spark: SparkSession, columns: list[str]) -> DataFrame:
        return spark.createDataFrame([], T.StructType([*self.schema.fields, *PARTS.fields])).select(*columns)

    def stream(self, spark: SparkSession, after_batch: int | None = None, max_files_per_trigger: int | None = None) -> DataFrame:
        """The table as a stream; with ``after_batch``, only what later batches wrote (pruned by partition, never read)."""
        reader = self._reader(spark, True)
        if max_files_per_trigger:
            reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
        rows = reader.parquet(self.path)
        if after_batch is not None:
            rows = rows.where(F.col(BATCH) > after_batch)
        return rows.select(*self.schema.fieldNames())

    def newest_batch(self, spark: SparkSession) -> int:
        """The last batch that wrote rows, -1 without any; read from the partitions' names and row counts."""
        newest = self._reader(spark).parquet(self.path).agg(F.max(BATCH)).first()[0]
        return -1 if newest is None else newest

    def write(self, rows: DataFrame, batch_id: int) -> datetime | None:
        """Put the rows of one batch in place of whatever that batch wrote before; returns their newest event time."""
        seen = Observation()
        out = rows.select(*self.schema.fieldNames()).observe(seen, F.max(self.time_col).alias("newest"))
        (out.withColumn(HOUR, hour_of(self.time_col)).withColumn(BATCH, F.lit(batch_id).cast("long"))
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(HOUR, BATCH).parquet(self.path))
        return seen.get.get("newest")

    def expired(self, spark: SparkSession, as_of: datetime) -> list[str]:
        """Hours that lie wholly behind ``as_of - keep``."""
        if self.keep is None:
            return []
        limit = (as_of - timedelta(microseconds=duration_us(self.keep))).strftime("%Y-%m-%d-%H")
        old = self._reader(spark).parquet(self.path).where(F.col(HOUR) < limit).select(HOUR).distinct()
        return sorted(r[0] for r in old.collect())     # a few hours at a time

    def expire(self, spark: SparkSession, as_of: datetime) -> list[str]:
        """Drop the expired hours; returns them."""
        hours = self.expired(spark, as_of)
        nothing = spark.createDataFrame([], T.StructType([*self.schema.fields, PARTS[BATCH]]))
        for h in hours:
            (nothing.write.mode("overwrite").option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false")
             .partitionBy(BATCH).parquet(f"{self.path}/{HOUR}={h}"))
        return hours

    def writer(self, replays: bool = True) -> Callable[[DataFrame, int], None]:
        """``foreachBatch`` body that appends each batch once and lets old hours go.

        The first batch after a start may be one that was written before the stop: if all its rows are there it is left
        as it is, so that streams reading the table do not meet it again under new file names. ``replays=False`` leaves
        that to a caller that takes out what is there itself.
        """
        state: dict[str, object] = {"first": replays, "newest": None, "hour": None}

        def body(batch: DataFrame, batch_id: int) -> None:
            spark = batch.sparkSession
            if state["first"]:
                state["first"] = False
                there = self.read(spark, parts=True).where(F.col(BATCH) == batch_id).count()
                if there and there == batch.count():
                    return
            newest = self.write(batch, batch_id)
            if newest is None or self.keep is None:
                return
            state["newest"] = max(newest, state["newest"] or newest)
            hour = state["newest"].replace(minute=0, second=0, microsecond=0)
            if hour != state["hour"]:     # hours expire when an hour begins
                self.expire(spark, state["newest"])
                state["hour"] = hour

        return body


def consumer_generation(spark: SparkSession, root: str, table: EventTable, on_restart: str = "resume") -> tuple[str, int | None]:
    """Checkpoint folder of a consumer of ``table``, and the batch behind which it starts (None: at the beginning).

    Generations are rows of a small table under ``root``. ``resume`` goes on with the newest one; ``skip`` opens the
    next, which starts behind what the table holds now and drops that backlog. A later ``resume`` goes on with that
    generation, so what was skipped stays skipped; skipped batches are never read, their partitions are left out.
    """
    if on_restart not in ("resume", "skip"):
        raise ValueError("on_restart must be 'resume' or 'skip'")
    record = T.StructType([T.StructField("generation", T.LongType()), T.StructField("after_batch", T.LongType())])
    try:
        known = spark.read.schema(record).parquet(f"{root}/generations").orderBy(F.col("generation").desc()).first()
    except AnalysisException as exc:
        if not is_missing_table(exc):
            raise
        known = None
    number, after = known or (0, None)
    if on_restart == "skip":
        number, after = number + 1, table.newest_batch(spark)
        spark.createDataFrame([(number, after)], record).coalesce(1).write.mode("append").parquet(f"{root}/generations")
    return f"{root}/checkpoint" + (f"-{number}" if number else ""), after


@dataclass(frozen=True)
class CarriedTable:
    """A small table carried from batch to batch: batch ``n`` is in folder ``n % 3``."""

    path: str
    schema: T.StructType

    def _full(self) -> T.StructType:
        return T.StructType([*self.schema.fields, PARTS[BATCH]])

    def version(self, spark: SparkSession, batch_id: int) -> DataFrame:
        """What ``batch_id`` left; empty for the batch before the first."""
        if batch_id < 0:
            return spark.createDataFrame([], self._full()).select(*self.schema.fieldNames())
        return (spark.read.schema(self._full()).parquet(f"{self.path}/{batch_id % 3}").where(F.col(BATCH) == batch_id)
                .select(*self.schema.fieldNames()))

    def write(self, rows: DataFrame, batch_id: int) -> None:
        rows.select(*self.schema.fieldNames()).withColumn(BATCH, F.lit(batch_id).cast("long")).write.mode("overwrite").parquet(
            f"{self.path}/{batch_id % 3}")

    def current(self, spark: SparkSession) -> DataFrame:
        """The newest version; empty before the first batch."""
        try:
            rows = spark.read.schema(self._full()).option("ignoreMissingFiles", "true").parquet(f"{self.path}/[012]")
        except AnalysisException as exc:
            if not is_missing_table(exc):
                raise
            return self.version(spark, -1)
        return rows.where(F.col(BATCH) == rows.select(F.max(BATCH)).scalar()).select(*self.schema.fieldNames())
