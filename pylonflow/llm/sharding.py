"""Sharding by a hierarchical weighted hash tree.

The tree has three levels: regions hold racks, racks hold shards, and a
node weighs what the shards below it weigh. A key descends it: at each
level every child draws a straw ``-ln(u) / weight``, with ``u`` a hash of key
and child in (0, 1), and the shortest straw wins. Each child wins with a
probability in proportion to its weight, and since a child's straw depends
on that child alone, changing one weight moves keys only into a subtree
whose weight grew or out of one whose weight shrank.

A tree is grown by hanging a new shard into a region and rack of its own:
then its region is the only node whose weight changes, and keys move into
the new shard and nowhere else.

Null keys draw like the empty string, null texts have no bytes, and every
input row is placed, repeated ids included. Only the named columns of the
input are read, so that others may carry any name.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pylonflow.llm.common import documents, global_index, stored

HEX = 13   # hex digits of a draw: 52 bits, exact in a double


@dataclass(frozen=True)
class Shard:
    region: str
    rack: str
    shard: int
    weight: float = 1.0


def even_tree(shards: int = 16, racks: int = 2, per_rack: int = 2) -> list[Shard]:
    """``shards`` leaves of weight 1 dealt over racks of ``per_rack`` and regions of ``racks`` racks."""
    return [Shard(f"r{s // (racks * per_rack)}", f"k{s // per_rack}", s) for s in range(shards)]


def grown(tree: list[Shard], shard: int, weight: float = 1.0) -> list[Shard]:
    """The tree with one more shard, in a new region and rack of its own."""
    return [*tree, Shard(f"r+{shard}", f"k+{shard}", shard, weight)]


def _levels(tree: list[Shard]) -> dict[str, list[tuple[str, float]]]:
    """Children and weights of every inner node ('' is the root). The tree is
    part of the cluster's configuration: its size does not follow the data."""
    if len({s.shard for s in tree}) != len(tree) or any(s.weight <= 0 for s in tree):
        raise ValueError("shard numbers must differ and weights be positive")
    out: dict[str, dict[str, float]] = {}
    for s in tree:
        path = ["", s.region, f"{s.region}/{s.rack}", f"{s.region}/{s.rack}/{s.shard}"]
        for parent, child in zip(path, path[1:], strict=False):
            kids = out.setdefault(parent, {})
            kids[child] = kids.get(child, 0.0) + s.weight
    return {p: sorted(kids.items()) for p, kids in out.items()}


def _draw(key: Column, children: Column) -> Column:
    """The child with the shortest straw; ties go to the smaller name."""
    def straw(child: Column) -> Column:
        u = (F.conv(F.substring(F.md5(F.concat(key, F.lit("@"), child["name"])), 1, HEX), 16, 10)
             .cast("double") + 0.5) / float(16 ** HEX)
        return F.struct((-F.log(u) / child["weight"]).alias("straw"), child["name"].alias("name"))
    return F.array_min(F.transform(children, straw))["name"]


def _children(kids: list[tuple[str, float]]) -> Column:
    return F.array(*[F.struct(F.lit(n).alias("name"), F.lit(float(w)).alias("weight")) for n, w in kids])


def tree_shard(key: Column, tree: list[Shard]) -> Column:
    """The shard of ``key``: a plain expression, no join and no shuffle."""
    levels = _levels(tree)
    key = F.coalesce(key.cast("string"), F.lit(""))
    inner = sorted(p for p in levels if p)
    below = F.create_map(*[x for p in inner for x in (F.lit(p), _children(levels[p]))])
    region = _draw(key, _children(levels[""]))
    rack = _draw(key, below[region])
    leaf = _draw(key, below[rack])
    return F.element_at(F.split(leaf, "/"), -1).cast("int")


def shard_documents(df: DataFrame, key: str = "doc_id", text: str = "text", tree: list[Shard] | None = None,
                    grown_tree: list[Shard] | None = None) -> DataFrame:
    """Place every row: key, size, text_crc32, shard, grown_shard and a gapless
    slot in its shard (by key, checksum, size).

    One scan computes the narrow columns; only those are shuffled, once, by
    ranges of (shard, key), so that a shard of any size is numbered by many tasks.
    """
    tree = tree or even_tree()
    grown_tree = grown_tree or grown(tree, max(s.shard for s in tree) + 1)
    raw = F.coalesce(F.col(text), F.lit("")).cast("binary")
    keyed = df.select(F.col(key).alias("doc_id"), (F.octet_length(raw) + F.lit(1)).cast("long").alias("size"),
                      F.crc32(raw).cast("long").alias("text_crc32"))
    order = ["shard", "doc_id", "text_crc32", "size"]
    placed = stored(keyed.withColumn("shard", tree_shard(F.col("doc_id"), tree))
                    .withColumn("grown_shard", tree_shard(F.col("doc_id"), grown_tree)), "shards")
    at = global_index(placed, order, "_index")
    start = at.groupBy(F.col("shard").alias("_shard")).agg(F.min("_index").alias("_start"))   # a row per shard
    return (at.join(F.broadcast(start), F.col("shard") == F.col("_shard"))
            .select("doc_id", "size", "text_crc32", "shard", (F.col("_index") - F.col("_start")).alias("slot"),
                    "grown_shard"))


def op2_hash_tree_sharding(spark, sf_dir: str) -> DataFrame:
    placed = shard_documents(documents(spark, sf_dir))
    return placed.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


# The default tree in SQL; the checksum is folded bytewise over a table made from the polynomial.
OP2_SQL = r"""
WITH tab AS (SELECT list(list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS t
             FROM (SELECT unnest(range(256)) AS i)),
d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, octet_length(encode(coalesce(text, '')))::BIGINT AS n FROM documents),
c AS (SELECT doc_id, n + 1 AS size, xor(list_reduce(list_prepend(4294967295, list_transform(range(n),
        lambda j: ('0x' || substr(h, 2 * j + 1, 2))::BIGINT)), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) AS text_crc32
      FROM d, tab),
leaf AS (SELECT 'r' || s // 4 AS region, 'r' || s // 4 || '/k' || s // 2 AS rack, 'r' || s // 4 || '/k' || s // 2 || '/' || s AS leaf, s AS shard
         FROM (SELECT unnest(range(16)) AS s)),
big AS (SELECT * FROM leaf UNION ALL SELECT 'r+16', 'r+16/k+16', 'r+16/k+16/16', 16),
node AS (SELECT DISTINCT grown, 1 AS level, '' AS parent, region AS name, count(*) OVER (PARTITION BY grown, region) AS w FROM (SELECT *, false AS grown FROM leaf UNION ALL SELECT *, true FROM big)
   UNION SELECT DISTINCT grown, 2, region, rack, count(*) OVER (PARTITION BY grown, rack) FROM (SELECT *, false AS grown FROM leaf UNION ALL SELECT *, true FROM big)
   UNION SELECT grown, 3, rack, leaf, 1 FROM (SELECT *, false AS grown FROM leaf UNION ALL SELECT *, true FROM big)),
k AS (SELECT DISTINCT coalesce(doc_id::VARCHAR, '') AS key FROM documents),
l1 AS (SELECT key, grown, arg_min(name, [-ln((('0x' || substr(md5(key || '@' || name), 1, 13))::BIGINT + 0.5::DOUBLE) / 4503599627370496) / w]) AS won FROM k, node WHERE level = 1 GROUP BY key, grown),
l2 AS (SELECT key, l1.grown, arg_min(name, [-ln((('0x' || substr(md5(key || '@' || name), 1, 13))::BIGINT + 0.5::DOUBLE) / 4503599627370496) / w]) AS won FROM l1 JOIN node ON level = 2 AND parent = won AND node.grown = l1.grown GROUP BY key, l1.grown),
l3 AS (SELECT key, l2.grown, arg_min(name, [-ln((('0x' || substr(md5(key || '@' || name), 1, 13))::BIGINT + 0.5::DOUBLE) / 4503599627370496) / w]) AS won FROM l2 JOIN node ON level = 3 AND parent = won AND node.grown = l2.grown GROUP BY key, l2.grown),
s AS (SELECT key, max(CASE WHEN NOT grown THEN string_split(won, '/')[-1]::INTEGER END) AS shard, max(CASE WHEN grown THEN string_split(won, '/')[-1]::INTEGER END) AS grown_shard FROM l3 GROUP BY key)
SELECT doc_id, size, text_crc32, 'key' AS law, shard,
       row_number() OVER (PARTITION BY shard ORDER BY doc_id NULLS FIRST, text_crc32, size) - 1 AS slot, grown_shard
FROM c JOIN s ON s.key = coalesce(doc_id::VARCHAR, '')
"""
