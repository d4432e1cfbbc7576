"""Batch and streaming readers for the parquet tables the engine is fed."""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pylonflow.session import apply_engine_conf


def _fix_ntz(df: DataFrame) -> DataFrame:
    """Cast ``timestamp_ntz`` columns to ``timestamp`` (session zone = UTC).

    ``withWatermark`` and ``F.window`` on streams need TimestampType; doing it
    once in the reader keeps every operator type-uniform.
    """
    ntz = [f.name for f in df.schema.fields if isinstance(f.dataType, T.TimestampNTZType)]
    if not ntz:
        return df
    return df.select(*[F.col(c).cast("timestamp").alias(c) if c in ntz else F.col(c) for c in df.columns])


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read one table of a scale-factor folder (column pruning and filter
    pushdown happen in the parquet scan once the plan is built)."""
    apply_engine_conf(spark)
    return _fix_ntz(spark.read.parquet(table_path(sf_dir, name)))


def stream_table(spark: SparkSession, sf_dir: str, name: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """The same table as an append-only file stream.

    File streams need a directory: a table stored as one file is streamed
    from its folder with a glob filter admitting only that file; a table
    stored as a folder of part files is streamed directly. The schema is
    taken from the batch reader once and fixed (streams never infer).
    """
    apply_engine_conf(spark)
    path = table_path(sf_dir, name)
    batch = spark.read.parquet(path)
    reader = spark.readStream.schema(batch.schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    files = [unquote(f) for f in batch.inputFiles()]   # file listing only, no data read
    if len(files) == 1 and files[0].rstrip("/").endswith("/" + f"{name}.parquet"):
        # a single-file table: stream its folder, admitting only that file
        return _fix_ntz(reader.option("pathGlobFilter", f"{name}.parquet").parquet(sf_dir.rstrip("/") + "/"))
    return _fix_ntz(reader.parquet(path))   # a table folder (part files)
