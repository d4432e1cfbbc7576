import math
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from pylonflow.llm import mixing as m


def waterfill(sizes, weights, cap):
    total, fixed = sum(sizes), {}
    while True:
        free = [k for k in range(len(sizes)) if k not in fixed]
        if not free:
            break
        level = (total - sum(fixed.values())) / sum(weights[k] for k in free)
        over = [k for k in free if weights[k] * level > cap * sizes[k]]
        if not over:
            return [fixed.get(k, weights[k] * level) for k in range(len(sizes))]
        fixed |= {k: cap * sizes[k] for k in over}
    return [fixed[k] for k in range(len(sizes))]


def tilt(sizes, target, cap):
    x = np.array(sizes, float)
    low, high = -60.0, 60.0
    for _ in range(300):
        mid = (low + high) / 2
        taken = (x * np.minimum(cap, np.exp(np.minimum(mid * x / x.mean(), 700)))).sum()
        low, high = (mid, high) if taken < target else (low, mid)
    return (low + high) / 2


@pytest.fixture(scope="module")
def mixed(spark):
    rng = np.random.default_rng(5)
    rows = [(int(i), " ".join(["w"] * int(rng.integers(1, 60))), s) for i, s in enumerate(
        ["a"] * 300 + ["b"] * 30 + ["B"] * 200 + [None] * 150 + ["é"] * 90)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    return rows, m.mix_documents(df).collect()


def test_targets_match_a_water_filling(spark, mixed):
    rows, got = mixed
    sizes = {}
    for _, t, s in rows:
        sizes[s] = sizes.get(s, 0) + len(t.split())
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None]
    want = dict(zip(order, waterfill([sizes[s] for s in order], [(5, 2, 1)[k % 3] for k in range(len(order))], 3.0), strict=True))
    source = {str(i): s for i, _, s in rows}
    for r in got:
        assert math.isclose(r["target"], want[source[r["doc_id"]]], rel_tol=1e-9) and r["source_size"] == sizes[source[r["doc_id"]]]
    assert math.isclose(sum(want.values()), sum(sizes.values()))


def test_taken_words_meet_targets_and_rates_are_tilted(spark, mixed):
    rows, got = mixed
    source = {str(i): s for i, _, s in rows}
    for s in set(source.values()):
        mine = [r for r in got if source[r["doc_id"]] == s]
        sizes, target = [r["size"] for r in mine], mine[0]["target"]
        assert abs(sum(r["copies"] * r["size"] for r in mine) - target) <= max(sizes)
        if target < 3 * sum(sizes) - 1:
            t = tilt(sizes, target, 3.0)
            for r in mine:
                rate = min(3.0, math.exp(t * r["size"] / np.mean(sizes)))
                assert math.floor(rate - 1e-6) <= r["copies"] <= math.ceil(rate + 1e-6)
        assert all(0 <= r["copies"] <= 3 for r in mine)


def test_reruns_agree_and_odd_rows(spark, odd_docs, no_docs):
    one, two = (sorted(map(tuple, m.mix_documents(odd_docs.repartition(n)).collect()), key=str) for n in (1, 5))
    assert [r[:4] for r in one] == [r[:4] for r in two] and [r[-1] for r in one] == [r[-1] for r in two]
    want = sorted((str(r["doc_id"]), len(re.findall(r"[^\x20\x09-\x0D]+", r["text"] or ""))) for r in odd_docs.collect())
    assert sorted((str(r[0]), r[2]) for r in one) == want
    assert m.mix_documents(no_docs).count() == 0
    empty = spark.createDataFrame([(1, None, "a"), (2, "", None)], "doc_id long, text string, source string")
    assert [(r["size"], r["target"], r["copies"]) for r in m.mix_documents(empty).collect()] == [(0, 0.0, 0)] * 2


@pytest.mark.parametrize("sizes,target", [([10] * 999 + [1_000_000], 1010.0), ([1_000_000] + [1] * 50, 30.0), ([1] * 5000 + [100_000], 250_000.0),
                                          ([7], 3.5), ([3, 1_000_000_000], 1e9 + 4)])
def test_far_tilts_are_found(spark, sizes, target):
    hist = spark.createDataFrame([("s", n, sizes.count(n)) for n in set(sizes)], "source string, size long, docs long")
    targets = spark.createDataFrame([("s", sum(sizes), len(sizes), target)], "source string, source_size long, docs long, target double")
    r = m.tilt_table(hist, targets).first()
    taken = sum(n * min(3.0, math.exp(min(r["tilt"] * n / r["mean"], 700))) for n in sizes)
    assert math.isclose(taken, target, rel_tol=1e-6), (r["tilt"], taken)


def test_too_few_rounds_are_an_error(spark, monkeypatch):
    monkeypatch.setattr(m, "ROUNDS", 2)
    hist = spark.createDataFrame([("s", 10, 999), ("s", 1_000_000, 1)], "source string, size long, docs long")
    with pytest.raises(RuntimeError, match="2 rounds"):
        m.tilt_table(hist, spark.createDataFrame([("s", 1_009_990, 1000, 1010.0)], "source string, source_size long, docs long, target double"))


def test_a_flood_of_equal_rows_is_dealt_out(spark):
    df = spark.range(200_000).selectExpr("CAST(NULL AS long) AS doc_id", "'w w w' AS text", "'a' AS source").unionByName(
        spark.createDataFrame([(k, "w " * (k % 9 + 1), "b") for k in range(2000)], "doc_id long, text string, source string"))
    got = m.mix_documents(df)
    by = {r["source_size"]: r for r in got.groupBy("source_size").agg({"*": "count", "target": "max"}).collect()}
    assert by[600_000]["count(1)"] == 200_000
    taken = {r["source_size"]: r["t"] for r in got.groupBy("source_size").agg(F.sum(F.col("copies") * F.col("size")).alias("t")).collect()}
    for size, r in by.items():
        assert abs(taken[size] - r["max(target)"]) <= 0.002 * r["max(target)"] + 30
    plan = got._jdf.queryExecution().toString()
    assert "partial_count" in plan


def test_positions_of_equal_rows_are_spread(spark):
    from pylonflow.llm.common import global_index
    df = spark.range(200_000).selectExpr("CAST(NULL AS long) AS k", "'same' AS v").repartition(8)
    got = global_index(df, ["k", "v"], "at", 8)
    parts = got.groupBy(F.spark_partition_id()).count().collect()
    assert len(parts) > 1 and sorted(r["at"] for r in got.collect()) == list(range(200_000))
