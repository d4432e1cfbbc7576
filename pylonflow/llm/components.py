"""Connected components of a link table, by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pylonflow.llm.common import stored


def _signature(e: DataFrame) -> tuple:
    return tuple(e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def connected_components(links: DataFrame) -> DataFrame:
    """(id, component) for every id in ``links`` (a, b): component is the smallest id reachable.

    Each round hangs every node under the smallest neighbour it knows, until
    nothing moves, however many rounds that takes (about the logarithm of the longest path). Nodes and links
    stay in stored tables; the driver sees two numbers a round.
    """
    e = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct()
    e = stored(e, "links")
    mark = _signature(e)
    while mark[0]:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        e = stored(small.unionByName(low.select("u", F.col("m").alias("v"))).where("u <> v").distinct(), "links")
        now = _signature(e)
        if now == mark:
            break
        mark = now
    roots = e.select(F.col("v").alias("id")).distinct().withColumn("component", F.col("id"))
    return e.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(
        roots.join(e.select(F.col("u").alias("id")), "id", "left_anti"))
