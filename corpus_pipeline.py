"""From raw documents to placed training documents, one operator a stage.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run``
writes it to the shared checkpoint folder and rereads it as the next one's
``docs``. All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pylonflow.llm import decontaminate, jaccard, mixing, quality, sharding
from pylonflow.llm.common import documents, stored


def _numbered(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with its columns renamed c0, c1, ...: names that a stage adds cannot clash with them."""
    names = {c: f"c{k}" for k, c in enumerate(docs.columns)}
    return docs.toDF(*names.values()), names


def _named(rows: DataFrame, names: dict[str, str]) -> DataFrame:
    return rows.select(*[F.col(short).alias(name) for name, short in names.items()])


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that some quality rule rejects go: null, empty and very short texts among them.

    Each row is judged by its own text; repeated rows stay or go alike.
    """
    rows, names = _numbered(docs)
    return _named(quality.quality_cascade(rows, names["text"], rows.columns).where("kept"), names)


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every group of linked documents the one with the smallest id stays.

    Rows without id are not grouped and stay. Rows that repeat an id stay or go together: every distinct one of them is
    kept, rows that are equal in all columns as one row.
    """
    groups = jaccard.jaccard_components(docs)
    stays = groups.where("id = component_id").select(F.col("id").alias("doc_id")).distinct()
    kept = docs.where("doc_id IS NOT NULL").join(stays, "doc_id", "left_semi").select(*docs.columns).distinct()
    return kept.unionByName(docs.where("doc_id IS NULL"))


def _row_key(key: str, text: str) -> Column:
    """128 bits of a row's id and text: rows that agree in it have equal texts."""
    parts = [F.col(key).isNull(), F.col(key).cast("string"), F.col(text).isNull(), F.col(text)]
    return F.concat_ws(":", F.xxhash64(*parts).cast("string"), F.xxhash64(F.lit(1), *parts).cast("string"))


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of the benchmark go, each by its own text: others with its id, or without id, stay."""
    rows, names = _numbered(docs)
    rows = rows.withColumn("_row", _row_key(names["doc_id"], names["text"]))
    found = decontaminate.contamination(rows, documents(spark, sf_dir, "benchmark"), "_row", names["text"])
    dirty = found.where("n_hit > 0").select(F.col("key").alias("_row")).distinct()
    return _named(rows.join(dirty, "_row", "left_anti"), names)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it: not at all, once, or repeated.

    The copies of rows that are equal to the mix are added up. Where such rows differ in other columns, each
    variant gets its share of the sum by the number of its rows, to whole copies.
    """
    taken = stored(mixing.mix_documents(docs).groupBy(F.col("doc_id").alias("_id"), F.col("row").alias("_mix_row"))
                   .agg(F.sum("copies").alias("copies"), F.count("*").alias("_rows")).where("copies > 0"), "taken")
    rows, names = _numbered(docs)
    rows = rows.withColumn("_row", mixing.row_hash(names["doc_id"], names["source"], names["text"]))
    same = F.col(names["doc_id"]).cast("string").eqNullSafe(F.col("_id")) & (F.col("_row") == F.col("_mix_row"))
    single = rows.join(taken.where("_rows = 1"), same).select(*names.values(), "copies")
    variants = rows.join(taken.where("_rows > 1"), same).groupBy(*names.values(), "_id", "_row", "copies", "_rows").agg(F.count("*").alias("_n"))
    upto = F.sum("_n").over(Window.partitionBy("_id", "_row").orderBy(*[F.col(c) for c in names.values()])
                            .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    share = lambda n: F.floor(F.col("copies") * n / F.col("_rows"))
    repeated = variants.withColumn("_upto", upto).select(
        *names.values(), (share(F.col("_upto")) - share(F.col("_upto") - F.col("_n"))).alias("copies"))
    kept = single.unionByName(repeated.where("copies > 0"))
    return _named(kept.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))), names)


def hash_tree_sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Shard and slot of every document that is left, by its id.

    A row without id has a place too (all of them in one shard); a null text is of size 1. Copies of a row share its
    shard and take slots of their own.
    """
    return sharding.shard_documents(docs).select("doc_id", "size", "text_crc32", "shard", "slot", "grown_shard")


STAGES = [
    ("quality_rules", quality_rules),
    ("ngram_jaccard_join", ngram_jaccard_join),
    ("benchmark_decontamination", benchmark_decontamination),
    ("source_mixing", source_mixing),
    ("hash_tree_sharding", hash_tree_sharding),
]

# The Jaccard join's components and the mix's Newton iterations have no SQL form; the
# pipeline is tested against a brute-force version (tests/llm/test_queries.py).
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage_{name}")
    return docs
