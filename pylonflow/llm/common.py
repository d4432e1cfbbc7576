"""Small helpers shared by the training-data operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pylonflow.session import scratch_path, ship_package
from pylonflow.sources.tables import read_table

# The two word patterns of the contracts, in Spark's (Java) and DuckDB's (RE2) common syntax.
SPACE_WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def documents(spark: SparkSession, sf_dir: str, name: str = "documents") -> DataFrame:
    ship_package(spark)
    return read_table(spark, sf_dir, name)


def stored(df: DataFrame, tag: str, compression: str = "zstd", **options: str) -> DataFrame:
    """Write ``df`` once to the shared checkpoint folder (with the writer's ``options``) and read it back.

    Cuts the lineage on storage every executor can reach: a lost executor
    costs a re-read, never a recomputation of what stands above, and jobs
    that follow scan the narrow table instead of the texts.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "llm", tag)
    df.write.options(compression=compression, **options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def global_index(df: DataFrame, order: list[str], out: str, partitions: int | None = None) -> DataFrame:
    """Add ``out``: the row's gapless position (from 0) in the total order ``order``.

    One range shuffle and a sort inside each partition; the partitions' row
    counts (one number each) become offsets. Rows that agree in every order
    column are interchangeable; their place in the input parts them, so that a
    hot key, or a flood of equal rows, is spread over as many ranges as it fills.
    """
    spark = df.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    at, tie = "_at_partition", "_tie"
    placed = stored(df.withColumn(tie, F.monotonically_increasing_id()).repartitionByRange(n, *order, tie)
                    .sortWithinPartitions(*order).drop(tie).withColumn(at, F.monotonically_increasing_id()), "index")
    part = F.shiftright(F.col(at), 33)
    sizes = placed.groupBy(part.alias("p")).count().collect()   # one row per partition
    offsets, total = {}, 0
    for p, c in sorted((r["p"], r["count"]) for r in sizes):
        offsets[p], total = total, total + c
    if not offsets:
        return placed.withColumn(out, F.lit(0).cast("long")).drop(at)
    table = F.create_map(*[F.lit(x) for kv in offsets.items() for x in (kv[0], kv[1])])
    return placed.withColumn(out, table[part] + F.col(at).bitwiseAND(F.lit((1 << 33) - 1))).drop(at)

