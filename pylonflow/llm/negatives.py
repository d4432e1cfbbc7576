"""Hard-negative mining by segment summaries.

A vector is cut into equal segments; of each its mean and its deviation are
stored. Over a segment of length n the inner product of two vectors is
``n * mean * mean`` give or take ``n * deviation * deviation`` (Cauchy-Schwarz on
what is left after the means), so that summaries alone bound a score from both
sides. Bounds start with the whole vector as one segment and are refined to
quarters and sixteenths for the pairs still open; a pair is dropped where its
upper bound is below what enough rows of its block surely reach, or its bounds
miss the window asked for. Pairs left after the finest segments are scored
exactly, in whole numbers.

Anchors are a stated share of the rows. Rows are dealt into groups of bounded
size, every anchor is sent to every group, and a task holds one group at a
time while the anchors stream by. Each group gives its own best rows, the best
of all are picked by rank; Spark keeps only the first ones of each task before
it shuffles them. The first pass finds the positives, the second one the
negatives in each positive's window.

Rows with a null label, a null vector or a component that is null or not finite
take no part. Shorter vectors count as filled up with zeros. A row without id is
a row like any other, last among equal scores, and is no anchor; rows that
repeat an id, or a whole row, stand for themselves. An empty table has an empty
result. Scores must fit into 64 bits. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pylonflow.llm.common import documents, stored
from pylonflow.session import ship_package

GROUP = 8192               # rows of a group, on average, at most
CHUNK = 128                # anchors bounded against a group at a time
SEGMENTS = (1, 4, 16)      # refinements, coarse to fine; each divides the next
PAIRS = 1 << 17            # pairs scored exactly at a time
LAST_ID = np.iinfo(np.int64).max
ROW = "rid long, id long, label long, v array<int>, means array<double>, devs array<double>"


def summaries(v: np.ndarray, segments: int) -> tuple[np.ndarray, np.ndarray]:
    """(means, deviations) of each row's ``segments`` equal segments."""
    parts = v.reshape(len(v), segments, -1).astype(float)
    return parts.mean(axis=2), parts.std(axis=2)


def coarser(means: np.ndarray, devs: np.ndarray, segments: int) -> tuple[np.ndarray, np.ndarray]:
    """Summaries of longer segments from those of their parts."""
    m, d = (x.reshape(len(x), segments, -1) for x in (means, devs))
    mean = m.mean(axis=2)
    return mean, np.sqrt(np.maximum((d * d + m * m).mean(axis=2) - mean * mean, 0.0))


class _Rows:
    """Vectors with their summaries at every level, as arrays."""

    def __init__(self, columns: list[pa.Array], length: int):
        self.rid, ids, self.label = (c.to_numpy(zero_copy_only=False) for c in (columns[0], pc.fill_null(columns[1], LAST_ID), columns[2]))
        self.id = ids
        n = len(self.rid)
        self.v = columns[3].flatten().to_numpy(zero_copy_only=False).reshape(n, length).astype(float)
        finest = [c.flatten().to_numpy(zero_copy_only=False).reshape(n, SEGMENTS[-1]) for c in columns[4:6]]
        self.levels = [finest if s == SEGMENTS[-1] else coarser(*finest, s) for s in SEGMENTS]

    def take(self, at) -> _Rows:
        out = object.__new__(_Rows)
        out.rid, out.id, out.label, out.v = self.rid[at], self.id[at], self.label[at], self.v[at]
        out.levels = [(m[at], d[at]) for m, d in self.levels]
        return out

    @staticmethod
    def joined(parts: list[_Rows]) -> _Rows:
        out = object.__new__(_Rows)
        out.rid, out.id, out.label, out.v = (np.concatenate([getattr(p, k) for p in parts]) for k in ("rid", "id", "label", "v"))
        out.levels = [tuple(np.concatenate([p.levels[k][x] for p in parts]) for x in (0, 1)) for k in range(len(SEGMENTS))]
        return out


def bounds(a: _Rows, b: _Rows, level: int) -> tuple[np.ndarray, np.ndarray]:
    """(lower, upper) bounds of all scores of ``a`` and ``b`` from one level's summaries, safe against rounding."""
    (am, ad), (bm, bd) = a.levels[level], b.levels[level]
    n = a.v.shape[1] // SEGMENTS[level]
    middle, width = n * (am @ bm.T), n * (ad @ bd.T)
    size = lambda m, d: np.sqrt(n * (m * m + d * d).sum(axis=1))
    width += 1e-9 * (1 + np.outer(size(am, ad), size(bm, bd)))
    return middle - width, middle + width


def scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of rows of whole numbers, side by side."""
    limit = (np.abs(a).max(initial=0) * np.abs(b).max(initial=0)) * a.shape[1]
    if limit < 2.0**53:
        return np.einsum("ij,ij->i", a, b).astype(np.int64)
    if limit < 2.0**63:
        return np.einsum("ij,ij->i", a.astype(np.int64), b.astype(np.int64))
    raise OverflowError("an inner product may not fit into 64 bits")


def _scored(a: _Rows, b: _Rows, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    parts = [scores(a.v[i[k:k + PAIRS]], b.v[j[k:k + PAIRS]]) for k in range(0, len(i), PAIRS)]
    return np.concatenate(parts) if parts else np.zeros(0, np.int64)


def _kth(x: np.ndarray, k: int) -> np.ndarray:
    """The k-th largest of each row, -inf where there are fewer."""
    if x.shape[1] < k:
        return np.full(len(x), -np.inf)
    return np.partition(x, x.shape[1] - k, axis=1)[:, x.shape[1] - k]


def _first(i: np.ndarray, k: int) -> np.ndarray:
    """Which of the sorted ``i`` are among the first ``k`` of their value."""
    return np.arange(len(i)) - np.searchsorted(i, i, "left") < k


def best_same(anchors: _Rows, rows: _Rows, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(anchor, row, score) of each anchor's first ``k`` other rows of its label; ``rows`` are sorted by label."""
    out = []
    for label in np.unique(anchors.label):
        mine = np.flatnonzero(anchors.label == label)
        lo, hi = np.searchsorted(rows.label, label, "left"), np.searchsorted(rows.label, label, "right")
        if lo == hi:
            continue
        a, b = anchors.take(mine), rows.take(slice(lo, hi))
        open_ = a.rid[:, None] != b.rid[None, :]
        for level in range(len(SEGMENTS)):
            lower, upper = bounds(a, b, level)
            open_ &= upper >= _kth(np.where(open_, lower, -np.inf), k)[:, None]
        i, j = np.nonzero(open_)
        s = _scored(a, b, i, j)
        order = np.lexsort((b.rid[j], b.id[j], -s, i))
        order = order[_first(i[order], k)]
        out.append((mine[i[order]], lo + j[order], s[order]))
    empty = np.zeros(0, np.int64)
    return tuple(np.concatenate(x) for x in zip(*out, strict=True)) if out else (empty, empty, empty)


def best_other(anchors: _Rows, rows: _Rows, low: np.ndarray, high: np.ndarray, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """For each window, (window, anchor, row, score) of each anchor's first ``k`` rows of other labels that score in it.

    ``low`` and ``high`` have a column a window; an empty window has ``low`` above ``high``.
    """
    open_ = anchors.label[:, None] != rows.label[None, :]
    for level in range(len(SEGMENTS)):
        lower, upper = bounds(anchors, rows, level)
        wanted = np.zeros_like(open_)
        for w in range(low.shape[1]):
            lo, hi = low[:, w, None], high[:, w, None]
            sure = open_ & (lower >= lo) & (upper <= hi)
            reached = np.full(len(lower), -np.inf)
            enough = np.flatnonzero(sure.sum(axis=1) >= k)
            reached[enough] = _kth(np.where(sure[enough], lower[enough], -np.inf), k)
            wanted |= (upper >= np.maximum(lo, reached[:, None])) & (lower <= hi) & (lo <= hi)
        open_ &= wanted
    i, j = np.nonzero(open_)
    s = _scored(anchors, rows, i, j)
    order = np.lexsort((rows.rid[j], rows.id[j], -s, i))
    i, j, s = i[order], j[order], s[order]
    for w in range(low.shape[1]):
        at = np.flatnonzero((s >= low[i, w]) & (s <= high[i, w]))
        at = at[_first(i[at], k)]
        yield w, i[at], j[at], s[at]


def summarised(df: DataFrame, key: str = "vec_id", vector: str = "embedding", label: Column | None = None,
               scale: float = 256.0) -> DataFrame:
    """Stored rows that take part: rid, id, label, the vector in whole numbers and its finest segments' summaries."""
    spark = df.sparkSession
    ship_package(spark)
    rows = df.select(F.col(f"`{key}`").cast("long").alias("id"), (F.col("label") if label is None else label).cast("long").alias("label"),
                     F.col(f"`{vector}`").cast("array<double>").alias("v"))
    odd = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = rows.where(F.col("label").isNotNull() & F.col("v").isNotNull() & ~odd)
    rows = rows.select(F.monotonically_increasing_id().alias("rid"), "id", "label", F.transform("v", lambda x: F.floor(x * scale).cast("int")).alias("v"))
    most = rows.agg(F.max(F.size("v"))).first()[0] or 0
    length = max(1, -(-most // SEGMENTS[-1])) * SEGMENTS[-1]
    rows = rows.withColumn("v", F.concat("v", F.array_repeat(F.lit(0), F.lit(length) - F.size("v"))))

    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo in range(0, b.num_rows, 4096):
                part = b.slice(lo, 4096)
                v = part.column(3).flatten().to_numpy(zero_copy_only=False).reshape(part.num_rows, length)
                at = pa.array(np.arange(part.num_rows + 1, dtype=np.int32) * SEGMENTS[-1])
                lists = [pa.ListArray.from_arrays(at, pa.array(x.ravel())) for x in summaries(v, SEGMENTS[-1])]
                yield pa.RecordBatch.from_arrays([*part.columns, *lists], names=["rid", "id", "label", "v", "means", "devs"])

    return stored(rows.mapInArrow(summarise, ROW), "summaries")


def _met(rows: DataFrame, anchors: DataFrame, total: int, length: int, work, schema: str) -> DataFrame:
    """``work(anchors, their windows, rows)`` for every anchor and every group of rows.

    A group's rows come first and are held, its anchors follow in batches.
    """
    spark = rows.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    groups = max(1, -(-total // GROUP), min(n, total // 1024))     # a small table is cut further, for more tasks
    n = min(n, groups)
    cols = ["rid", "id", "label", "v", "means", "devs"]
    dealt = (rows.select(F.pmod(F.xxhash64("rid"), F.lit(groups)).alias("g"), F.lit(0).alias("kind"), *cols, F.lit(None).cast("array<long>").alias("asked"))
             .unionByName(anchors.select(F.explode(F.sequence(F.lit(0).cast("long"), F.lit(groups - 1).cast("long"))).alias("g"), F.lit(1).alias("kind"), *cols, "asked")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, parts, held = None, [], None
        for b in batches:
            place = b.column(0).to_numpy() * 2 + b.column(1).to_numpy()
            for lo, hi in _runs(place):
                g, kind = divmod(int(place[lo]), 2)
                if now != g:
                    now, parts, held = g, [], None
                if kind == 0:
                    parts.append(_Rows([c.slice(lo, hi - lo) for c in b.columns[2:8]], length))
                    continue
                if held is None and parts:
                    held = _Rows.joined(parts)
                    held, parts = held.take(np.argsort(held.label, kind="stable")), []
                for k in range(lo, hi, CHUNK) if held is not None else ():
                    some = b.slice(k, min(CHUNK, hi - k))
                    yield from work(_Rows(some.columns[2:8], length), some.column(8), held)

    return dealt.repartition(n, "g").sortWithinPartitions("g", "kind").mapInArrow(run, schema)


def _runs(x: np.ndarray) -> Iterator[tuple[int, int]]:
    cuts = [0, *(np.flatnonzero(x[1:] != x[:-1]) + 1).tolist(), len(x)]
    return zip(cuts[:-1], cuts[1:], strict=True) if len(x) else iter(())


def _ids(x: np.ndarray) -> pa.Array:
    return pa.array(x, mask=x == LAST_ID)


def _ranked(df: DataFrame, keys: list[str], score: str, key: str, row: str, k: int) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.desc(score), F.asc_nulls_last(key), row)
    return df.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def hard_negatives(rows: DataFrame, anchors: Column, positives: int = 5, negatives: int = 10,
                   window: tuple[int, int] = (30, 90)) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) of ``summarised`` rows.

    ``anchors`` says which rows are anchors. A negative scores between ``window`` percent of its positive's score.
    """
    low, high = window
    facts = rows.agg(F.count("*").alias("n"), F.max(F.size("v")).alias("d")).first()
    total, length = facts["n"], facts["d"] or SEGMENTS[-1]
    chosen = rows.where(anchors)

    def same(a: _Rows, _, b: _Rows) -> Iterator[pa.RecordBatch]:
        i, j, s = best_same(a, b, positives)
        yield pa.RecordBatch.from_arrays([pa.array(a.rid[i]), _ids(b.id[j]), pa.array(b.rid[j]), pa.array(s)],
                                         names=["anchor", "positive_id", "positive", "positive_score"])

    found = _met(rows, chosen.withColumn("asked", F.lit(None).cast("array<long>")), total, length, same,
                 "anchor long, positive_id long, positive long, positive_score long")
    found = stored(_ranked(found, ["anchor"], "positive_score", "positive_id", "positive", positives).withColumnRenamed("rank", "place"), "positives")
    asked = found.groupBy("anchor").agg(F.sort_array(F.collect_list(F.struct("place", "positive_score"))).alias("x"))   # at most ``positives`` each
    asked = chosen.join(asked.select(F.col("anchor").alias("rid"), F.col("x.positive_score").alias("asked")), "rid")

    def other(a: _Rows, scores_: pa.Array, b: _Rows) -> Iterator[pa.RecordBatch]:
        lists = scores_.to_pylist()
        lows, highs = np.ones((len(lists), positives), np.int64), np.zeros((len(lists), positives), np.int64)
        for i, p in enumerate(lists):
            lows[i, :len(p)] = [-(-low * s // 100) for s in p]
            highs[i, :len(p)] = [high * s // 100 for s in p]
        for w, i, j, s in best_other(a, b, lows, highs, negatives):
            yield pa.RecordBatch.from_arrays(
                [pa.array(a.rid[i]), pa.array(np.full(len(i), w + 1, np.int32)), _ids(b.id[j]), pa.array(b.rid[j]), pa.array(s)],
                names=["anchor", "place", "negative_id", "negative", "negative_score"])

    met = _met(rows, asked, total, length, other, "anchor long, place int, negative_id long, negative long, negative_score long")
    best = _ranked(met, ["anchor", "place"], "negative_score", "negative_id", "negative", negatives)
    ids = chosen.select(F.col("rid").alias("anchor"), F.col("id").alias("anchor_id"))
    return best.join(found, ["anchor", "place"]).join(ids, "anchor").select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def op12_hard_negatives(spark, sf_dir: str) -> DataFrame:
    """Anchors are the rows whose id is divisible by 100; where it is divisible by 7 the label is moved by one."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label").cast("long") + 1) % 10).otherwise(F.col("label"))
    rows = summarised(documents(spark, sf_dir, "embeddings"), label=label)
    return hard_negatives(rows, F.col("id") % 100 == 0)


OP12_SQL = """
WITH moved AS (
  SELECT row_number() OVER () AS rid, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label::BIGINT + 1) % 10 ELSE label END AS label,
         [floor(256 * x::DOUBLE) for x in embedding] AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0),
scored AS (
  SELECT a.rid AS anchor, a.vec_id AS anchor_id, a.label = r.label AS same, r.rid, r.vec_id, list_inner_product(a.v, r.v)::BIGINT AS score
  FROM moved a JOIN moved r ON a.vec_id % 100 = 0 AND a.rid <> r.rid),
positives AS (
  SELECT * FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, vec_id, rid) <= 5),
negatives AS (
  SELECT p.anchor_id, p.vec_id AS positive_id, n.vec_id AS negative_id, p.score AS positive_score, n.score AS negative_score,
         row_number() OVER (PARTITION BY p.anchor, p.rid ORDER BY n.score DESC, n.vec_id, n.rid) AS rank
  FROM positives p JOIN scored n ON p.anchor = n.anchor AND NOT n.same AND 30 * p.score <= 100 * n.score AND 100 * n.score <= 90 * p.score)
SELECT anchor_id, positive_id, rank::INTEGER AS rank, negative_id, positive_score, negative_score FROM negatives WHERE rank <= 10
"""
