"""Hard negatives against plain scoring, and their SQL."""

import math

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from pylonflow.llm import negatives
from tests.conftest import SF01

SCHEMA = "vec_id long, embedding array<float>, label int, rid string, v string, g int"


def brute(rows):
    kept = []
    for key, vector, label in rows:
        if label is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        moved = (label + 1) % 10 if key is not None and key % 7 == 0 else label
        kept.append((key, moved, [math.floor(256 * float(np.float32(x))) for x in vector]))
    out = []

    def score(a, b):
        return sum(x * y for x, y in zip(a[2], b[2], strict=False))

    def order(x):
        return -x[0], x[1][0] is None, x[1][0] or 0, x[2]

    for n, a in enumerate(kept):
        if a[0] is None or a[0] % 100:
            continue
        others = [(score(a, b), b, k) for k, b in enumerate(kept) if k != n]
        for p, b, _ in sorted((x for x in others if x[1][1] == a[1]), key=order)[:5]:
            window = sorted((x for x in others if x[1][1] != a[1] and 30 * p <= 100 * x[0] <= 90 * p), key=order)[:10]
            out += [(a[0], b[0], k, c[0], p, s) for k, (s, c, _) in enumerate(window, 1)]
    return sorted(out, key=repr)


def mined(df):
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label").cast("long") + 1) % 10).otherwise(F.col("label"))
    got = negatives.hard_negatives(negatives.summarised(df, label=label), F.col("id") % 100 == 0)
    return sorted((tuple(r) for r in got.collect()), key=repr)


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", 1) for r in rows], SCHEMA).repartition(5)


@pytest.mark.parametrize("group,chunk", [(8192, 128), (40, 2)])
def test_equals_plain_scoring(spark, monkeypatch, group, chunk):
    monkeypatch.setattr(negatives, "GROUP", group)
    monkeypatch.setattr(negatives, "CHUNK", chunk)
    monkeypatch.setattr(negatives, "PAIRS", 50)
    rnd = np.random.default_rng(3)
    centres = rnd.normal(size=(4, 23))
    rows = [(k * 5, (centres[k % 4] + 0.8 * rnd.normal(size=23)).astype(np.float32).tolist(), int(k % 4)) for k in range(400)]
    rows += [(1100, None, 1), (1200, rows[3][1], None), (1300, [float("nan")] * 23, 0), (1400, [1.0, None], 0),
             (1500, [float("inf")] * 23, 2), (None, rows[8][1], 0), (1600, [], 3), (1700, [0.5, -0.25], 1), (-100, rows[0][1], -1)]
    assert mined(table(spark, rows)) == brute(rows)


def test_ties_and_repeated_rows(spark, monkeypatch):
    monkeypatch.setattr(negatives, "GROUP", 64)
    vector = [0.5] * 16
    rows = [(k, vector, k % 3) for k in range(300)] + [(k + 1000, [0.3] * 16, 1) for k in range(50)]
    assert mined(table(spark, rows)) == brute(rows)
    # a third of all rows is one row, repeated; all of them are other rows to each other
    rows += [(500, vector, 2)] * 3 + [(501, [0.25] * 16, 5)] * 170
    got, want = mined(table(spark, rows)), brute(rows)
    assert got == want


def test_nothing_to_mine(spark):
    assert mined(table(spark, [])) == []
    assert mined(table(spark, [(100, [1.0], 1)])) == []
    assert mined(table(spark, [(100, [1.0], 1), (1, [1.0], 1), (2, [-1.0], 2)])) == []


def test_bounds_hold_and_tighten():
    rnd, length = np.random.default_rng(1), 64
    v = np.floor(256 * rnd.normal(size=(60, length))).astype(np.int32)

    def rows(x):
        lists = [pa.array(list(y)) for y in negatives.summaries(x, negatives.SEGMENTS[-1])]
        ids = pa.array(range(len(x)))
        return negatives._Rows([ids, ids, ids, pa.array(list(x)), *lists], length)

    a, b = rows(v[:20]), rows(v[20:])
    exact, width = v[:20].astype(int) @ v[20:].astype(int).T, math.inf
    for level in range(len(negatives.SEGMENTS)):
        lower, upper = negatives.bounds(a, b, level)
        assert (lower <= exact).all() and (exact <= upper).all()
        assert (upper - lower).mean() < width
        width = (upper - lower).mean()
    # a row of equal components is its mean: the bounds meet
    flat = rows(np.full((3, length), 7, np.int32))
    lower, upper = negatives.bounds(flat, b, 0)
    assert np.allclose(lower, upper, rtol=1e-6, atol=1)


def test_scores_are_exact_beyond_floating_point():
    a = np.array([[2.0**30 + 1] * 3])
    assert negatives.scores(a, a).tolist() == [3 * (2**30 + 1) ** 2]
    with pytest.raises(OverflowError):
        negatives.scores(np.full((1, 64), 2.0**30), np.full((1, 64), 2.0**30))


def test_query_equals_its_sql(spark):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{SF01}/embeddings.parquet')")
    want = sorted(con.sql(negatives.OP12_SQL).fetchall())
    assert sorted(tuple(r) for r in negatives.op12_hard_negatives(spark, SF01).collect()) == want and len(want) > 100
