import hashlib
import math
import zlib
from collections import Counter

import pytest

from pylonflow.llm import sharding as s


def descend(key, tree):
    levels = s._levels(tree)
    node = ""
    while node in levels:
        draws = []
        for name, weight in levels[node]:
            u = (int(hashlib.md5(f"{key}@{name}".encode()).hexdigest()[:s.HEX], 16) + 0.5) / 16 ** s.HEX
            draws.append((-math.log(u) / weight, name))
        node = min(draws)[1]
    return int(node.split("/")[-1])


def test_matches_brute_force_and_slots_are_gapless(spark, odd_docs):
    tree = s.even_tree()
    got = s.shard_documents(odd_docs).collect()
    assert len(got) == odd_docs.count()
    for r in got:
        key = "" if r["doc_id"] is None else r["doc_id"]
        assert r["shard"] == descend(key, tree) and r["grown_shard"] == descend(key, s.grown(tree, 16))
    for shard, n in Counter(r["shard"] for r in got).items():
        assert sorted(r["slot"] for r in got if r["shard"] == shard) == list(range(n))
    texts = Counter((r["doc_id"], len((r["text"] or "").encode()) + 1, zlib.crc32((r["text"] or "").encode()))
                    for r in odd_docs.collect())
    assert texts == Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got)


def test_growing_moves_only_into_the_new_shard(spark):
    df = spark.range(20_000).withColumnRenamed("id", "doc_id").selectExpr("doc_id", "CAST(doc_id AS string) AS text")
    got = s.shard_documents(df).collect()
    moved = [r for r in got if r["shard"] != r["grown_shard"]]
    assert {r["grown_shard"] for r in moved} == {16}
    assert abs(len(moved) - 20_000 / 17) < 200
    assert max(Counter(r["shard"] for r in got).values()) < 1.15 * 20_000 / 16


def test_a_weight_change_moves_keys_only_across_its_subtree(spark):
    tree = s.even_tree()
    heavier = [s.Shard(x.region, x.rack, x.shard, 3.0 if x.shard == 5 else 1.0) for x in tree]
    before = {k: descend(k, tree) for k in range(4000)}
    after = {k: descend(k, heavier) for k in range(4000)}
    region = {x.shard: x.region for x in tree}
    rack = {x.shard: x.rack for x in tree}
    for k in before:
        if before[k] != after[k]:   # out of another region, or rack, into the grown one, or within the rack into shard 5
            assert region[after[k]] == region[5]
            if region[before[k]] == region[5]:
                assert rack[after[k]] == rack[5]
                if rack[before[k]] == rack[5]:
                    assert after[k] == 5


def test_weights_draw_in_proportion():
    tree = [s.Shard("a", "r", 0, 1.0), s.Shard("b", "r", 1, 3.0)]
    n = Counter(descend(k, tree) for k in range(8000))
    assert abs(n[1] / 8000 - 0.75) < 0.02


def test_bad_trees_and_empty_tables(spark, no_docs):
    with pytest.raises(ValueError):
        s._levels([s.Shard("a", "r", 0), s.Shard("b", "r", 0)])
    assert s.shard_documents(no_docs).count() == 0
