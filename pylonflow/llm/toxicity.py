"""Toxicity: a convolutional text classifier on hashed word embeddings.

A lower-cased word is embedded as the sum of two hashed embeddings, its
own and that of its first letters, so that an unseen form of a known stem is
not unknown. Filters of several widths run over a whole text; the largest
response of each filter (max pooling) feeds a logistic output.

The net learns from every labelled text. The texts, as bucket numbers, are dealt by a
hash into parts of a bounded size (``Settings.max_train_rows`` and ``max_train_chars``); in a round every part trains
a copy of the net in a task of its own, in numpy, and the copies are averaged in groups, an embedding over the parts that
met it; the next round starts from the average. One labelled row in ``calibration`` is not trained on: all of these
give one decision threshold a language, the one of the best F1, found by sorting within narrow ranges of scores. A score
depends on the text alone; language only selects the threshold.

The trained net is a few MB whatever the corpus holds and goes to every
task with the scoring function; scoring is one pass without a shuffle.
Null and empty texts get the output bias as score, repeated rows one row
each. With no labelled text every score is 0.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pylonflow.llm.common import documents, stored
from pylonflow.llm.decontaminate import _slices, words_of
from pylonflow.session import ship_package


@dataclass(frozen=True)
class Settings:
    max_train_rows: int = 12_000   # about as many rows train in one task, calibration rows included
    buckets: int = 1 << 15
    dims: int = 16
    widths: tuple[int, ...] = (1, 2, 3)
    filters: int = 12
    max_train_chars: int = 60_000_000   # and about as many characters
    epochs: int = 6                # at least, a round each; a small part is gone over until it has had ``least_steps``
    least_steps: int = 500
    batch: int = 64                # at most; a small part is cut into smaller ones
    rate: float = 0.01
    decay: float = 1e-4
    calibration: int = 6           # one row in so many calibrates
    seed: int = 11


@dataclass
class Net:
    settings: Settings
    embed: np.ndarray
    filters: list[np.ndarray]      # for each width: (width, dims, filters)
    bias: list[np.ndarray]
    out: np.ndarray
    out_bias: float
    thresholds: dict[str, float] = field(default_factory=dict)   # "" is the common one


STEM = 4   # code points of a word's beginning that have an embedding
_BUCKET: dict[int, dict[bytes, tuple[int, int]]] = {}   # by number of buckets


def _buckets_of(word: bytes, buckets: int) -> tuple[int, int]:
    stem = word.decode("utf-8", "replace")[:STEM].encode() + b"~"
    return 1 + zlib.crc32(word) % buckets, 1 + zlib.crc32(stem) % buckets


def coded_words(texts: pa.Array, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All words as numbers of the distinct words, the (word, stem) buckets of those (from 1; 0 is the
    padding), and each text's number of words."""
    words, counts = words_of(texts)
    if not len(words):
        return np.empty(0, np.int32), np.zeros((1, 2), np.int32), counts
    coded = words.dictionary_encode()
    known = _BUCKET.setdefault(buckets, {})
    if len(known) > 300_000:   # a worker's memory stays bounded
        known.clear()
    table = np.array([known.get(w) or known.setdefault(w, _buckets_of(w, buckets))
                      for w in coded.dictionary.to_pylist()], np.int32)
    return coded.indices.to_numpy(), table, counts


def _padded(ids: np.ndarray, counts: np.ndarray, pad: int) -> tuple[np.ndarray, np.ndarray]:
    """Texts one after another with ``pad`` zeros behind each, and the places of their words."""
    place = np.arange(len(ids)) + np.repeat(np.arange(len(counts)) * pad, counts)
    out = np.zeros(len(ids) + pad * len(counts), np.int32)
    out[place] = ids
    return out, place


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def score_texts(net: Net, tables: list[list[np.ndarray]], codes: np.ndarray, distinct: np.ndarray,
                counts: np.ndarray) -> np.ndarray:
    """Scores of texts; ``tables`` holds each bucket's response to each row of each filter."""
    pooled = np.zeros((len(counts), len(net.out)), np.float32)
    has = counts > 0
    if has.any():
        seq, place = _padded(codes + 1, counts, max(net.settings.widths) - 1)
        pairs = np.concatenate([np.zeros((1, 2), np.int32), distinct])
        firsts = (np.cumsum(counts) - counts)[has]
        for k, rows in enumerate(tables):
            by_word = [r[pairs[:, 0]] + r[pairs[:, 1]] for r in rows]
            resp = by_word[0][seq[place]]
            for j in range(1, len(rows)):
                resp += by_word[j][seq[place + j]]
            n = net.settings.filters
            pooled[has, k * n: (k + 1) * n] = np.maximum(np.maximum.reduceat(resp, firsts, axis=0) + net.bias[k], 0)
    return _sigmoid(pooled @ net.out + net.out_bias).astype(float)


def response_tables(net: Net) -> list[list[np.ndarray]]:
    return [[net.embed @ w[j] for j in range(w.shape[0])] for w in net.filters]


def begun(rate: float, s: Settings) -> Net:
    """The net before its first step; ``rate`` is the share of texts with label 1."""
    rng = np.random.default_rng(s.seed)
    embed = rng.normal(0, 0.1, (s.buckets + 1, s.dims)).astype(np.float32)
    embed[0] = 0
    filters = [rng.normal(0, 0.3 / w, (w, s.dims, s.filters)).astype(np.float32) for w in s.widths]
    bias = [np.zeros(s.filters, np.float32) for _ in s.widths]
    out = rng.normal(0, 0.3, s.filters * len(s.widths)).astype(np.float32)
    rate = float(np.clip(rate, 1e-3, 1 - 1e-3))
    return Net(s, embed, filters, bias, out, float(np.float32(np.log(rate / (1 - rate)))))


def train(texts: list[np.ndarray], labels: np.ndarray, s: Settings) -> Net:
    """A net learnt from these texts alone: all epochs in one go."""
    return learn(begun(labels.mean() if len(labels) else 0.0, s), texts, labels, s.seed, 1)


def learn(net: Net, texts: list[np.ndarray], labels: np.ndarray, seed: int, rounds: int) -> Net:
    """``net`` after one of ``rounds`` turns over (words, 2) bucket arrays: Adam on the logistic loss; gradients flow only
    through each filter's largest response.

    A step moves only the embeddings that it met. Few texts are gone over more often, in smaller batches.
    """
    s, rng = net.settings, np.random.default_rng(seed)
    embed, filters, bias, out = net.embed.copy(), [w.copy() for w in net.filters], [x.copy() for x in net.bias], net.out.copy()
    out_bias = np.array([net.out_bias], np.float32)
    params = [embed, *filters, *bias, out, out_bias]
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    nw, nf, pad, step = len(s.widths), s.filters, max(s.widths) - 1, 0
    size = min(s.batch, max(16, len(texts) // 20))
    epochs = max(s.epochs, -(-s.least_steps * size // max(len(texts), size)))
    for _ in range(-(-epochs // rounds)):
        order = rng.permutation(len(texts))
        for at in range(0, len(order), size):
            rows = [r for r in order[at: at + size] if len(texts[r])]
            if not rows:
                continue
            step += 1
            y = labels[rows].astype(np.float32)
            counts = np.array([len(texts[r]) for r in rows])
            own, place = _padded(np.concatenate([texts[r][:, 0] for r in rows]), counts, pad)
            stem, _ = _padded(np.concatenate([texts[r][:, 1] for r in rows]), counts, pad)
            e = embed[own] + embed[stem]
            starts = np.cumsum(counts + pad) - counts - pad
            peak = np.empty((len(rows), nw, nf), np.int64)
            act = np.empty((len(rows), nw, nf), np.float32)
            for k, w in enumerate(s.widths):
                resp = sum(e[j: len(e) - pad + j] @ filters[k][j] for j in range(w)) + bias[k]
                for d, (b, n) in enumerate(zip(starts, counts, strict=True)):
                    peak[d, k] = resp[b: b + n].argmax(0) + b
                    act[d, k] = resp[peak[d, k], np.arange(nf)]
            hidden = np.maximum(act, 0).reshape(len(rows), -1)
            error = (_sigmoid(hidden @ out + out_bias[0]) - y) / len(rows)
            met = [np.concatenate([x[peak[:, k] + j].ravel() for k, w in enumerate(s.widths) for j in range(w)]) for x in (own, stem)]
            met, place = np.unique(np.concatenate(met), return_inverse=True)
            place = iter(np.split(place, 2 * sum(s.widths)))
            grads = [np.zeros((len(met), s.dims), np.float32), *[np.zeros_like(p) for p in params[1:]]]
            grads[-2][:] = hidden.T @ error
            grads[-1][:] = error.sum()
            back = (error[:, None] * out[None]).reshape(len(rows), nw, nf) * (act > 0)
            moves = []
            for k, w in enumerate(s.widths):
                g = back[:, k]
                grads[1 + nw + k][:] = g.sum(0)
                for j in range(w):
                    grads[1 + k][j] = np.einsum("df,dfe->ef", g, e[peak[:, k] + j])
                    moves.append((g[:, :, None] * filters[k][j].T[None]).reshape(-1, s.dims))
            for moved in (*moves, *moves):    # words, then stems
                np.add.at(grads[0], next(place), moved)
            grads[0][met == 0] = 0
            for n, (p, g, m, v) in enumerate(zip(params, grads, first, second, strict=True)):
                rows = met if n == 0 else slice(None)
                g += s.decay * p[rows]
                m[rows] += 0.1 * (g - m[rows])
                v[rows] += 0.001 * (g * g - v[rows])
                p[rows] -= s.rate * (m[rows] / (1 - 0.9 ** step)) / (np.sqrt(v[rows] / (1 - 0.999 ** step)) + 1e-8)
            embed[0] = 0
    return Net(s, embed, filters, bias, out, float(out_bias[0]))


def best_threshold(scores: np.ndarray, labels: np.ndarray, default: float = 0.5, least: int = 20) -> float:
    """The score cut with the best F1; ``default`` where fewer than ``least`` rows or one class only are there."""
    if len(scores) < least or labels.min() == labels.max():
        return default
    order = np.argsort(-scores, kind="stable")
    right = np.cumsum(labels[order])
    f1 = 2 * right / (np.arange(1, len(order) + 1) + labels.sum())
    last_of_tie = np.append(np.diff(scores[order]) != 0, True)
    k = int(np.argmax(np.where(last_of_tie, f1, -1)))
    below = scores[order][k + 1] if k + 1 < len(order) else 0.0
    return float((scores[order][k] + below) / 2)


def score_bin(scores: np.ndarray) -> np.ndarray:
    """The narrow range of log-odds that a score is in: higher scores never have lower ranges."""
    p = np.clip(scores, 1e-13, 1 - 1e-13)
    return np.floor((np.log(p) - np.log1p(-p)) * 100).astype(np.int32)


def best_thresholds(scored: DataFrame, default: float = 0.5, least: int = 20) -> dict[str, float]:
    """``best_threshold`` of all rows of (lang, score, bin, label), and of each language with that as its default.

    ``bin`` is the score's range: rows are counted by score, ranges added up, and only inside a range are scores sorted.
    """
    group = ["everything", "lang"]
    both = F.array(*[F.struct(F.lit(e).alias("everything"), c.alias("lang")) for e, c in ((True, F.lit("")), (False, F.coalesce("lang", F.lit(""))))])
    tied = (scored.select(F.explode(both).alias("g"), "score", "bin", "label").groupBy("g.everything", "g.lang", "bin", "score")
            .agg(F.count("*").alias("n"), F.sum("label").alias("right")))
    falling = Window.partitionBy(*group).orderBy(F.col("bin").desc())     # a few thousand ranges at most
    whole, above = Window.partitionBy(*group), falling.rowsBetween(Window.unboundedPreceding, -1)
    bins = tied.groupBy(*group, "bin").agg(F.sum("n").alias("n"), F.sum("right").alias("right"), F.max("score").alias("top")).select(
        *group, "bin", *[F.coalesce(F.sum(c).over(above), F.lit(0)).alias(f"{c}_above") for c in ("n", "right")],
        *[F.sum(c).over(whole).alias(f"{c}_all") for c in ("n", "right")], F.lead("top").over(falling).alias("top_below"))
    inside = Window.partitionBy(*group, "bin").orderBy(F.col("score").desc())
    so_far = inside.rowsBetween(Window.unboundedPreceding, 0)
    cuts = tied.join(bins, [*group, "bin"]).select(
        *group, "score", "n_all", "right_all", F.coalesce(F.lead("score").over(inside), "top_below", F.lit(0.0)).alias("below"),
        (2 * (F.col("right_above") + F.sum("right").over(so_far)) / (F.col("n_above") + F.sum("n").over(so_far) + F.greatest("right_all", F.lit(1)))).alias("f1"))
    best = (cuts.groupBy(*group).agg(F.max_by(F.struct("score", "below"), F.struct("f1", "score")).alias("cut"), F.first("n_all").alias("n"),
                                     F.first("right_all").alias("right")).collect())    # a row a language
    out = {"": default}
    for r in sorted(best, key=lambda r: (not r["everything"], r["lang"])):    # the common one first
        known = r["n"] >= least and 0 < r["right"] < r["n"]
        out[r["lang"]] = (r["cut"]["score"] + r["cut"]["below"]) / 2 if known else default
        if r["everything"]:
            default = out[""]
    return out


def sized(rows: DataFrame) -> DataFrame:
    """``rows`` (text, lang, perhaps key and label) with the hash ``h`` they are drawn by and their ``chars``."""
    text = F.coalesce("text", F.lit(""))
    return rows.select(text.alias("text"), F.col("lang").cast("string").alias("lang"), *[F.col("label").cast("int").alias("label") for c in rows.columns if c == "label"],
                       F.xxhash64(*[F.col("key").cast("string") for c in rows.columns if c == "key"], text).alias("h"), F.length(text).alias("chars"),
                       *[F.col("key") for c in rows.columns if c == "key"])


EMBEDDINGS = 256   # of one row of a moved net
FAN_IN = 256       # parts averaged in one group


def _rest(net: Net) -> np.ndarray:
    return np.concatenate([*[w.ravel() for w in net.filters], *net.bias, net.out, np.array([net.out_bias])]).astype(np.float32)


def moves_of(old: Net, new: Net) -> list[tuple[int, bytes, bytes]]:
    """(chunk, how many parts met each of its rows, sum of their moves): embeddings by the hundreds, then all the rest."""
    moved, out = new.embed - old.embed, []
    for k in range(0, len(moved), EMBEDDINGS):
        part = moved[k: k + EMBEDDINGS]
        met = part.any(1)
        if met.any():
            out.append((k // EMBEDDINGS, met.astype(np.int32).tobytes(), part.tobytes()))
    return [*out, (-1, np.ones(1, np.int32).tobytes(), (_rest(new) - _rest(old)).tobytes())]


def averaged(net: Net, moves: DataFrame, parts: int) -> Net:
    """``net`` moved by the mean of its copies' moves (part, chunk, met, moved); sums are taken in the order of parts."""

    def add(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("part", kind="stable")
        met = sum(np.frombuffer(x, np.int32) for x in rows["met"])
        moved = sum(np.frombuffer(x, np.float32) for x in rows["moved"])
        return pd.DataFrame({"part": [int(rows["part"].iloc[0]) // FAN_IN], "chunk": rows["chunk"].iloc[:1].to_numpy(),
                             "met": [met.astype(np.int32).tobytes()], "moved": [moved.astype(np.float32).tobytes()]})

    while True:
        moves = moves.groupBy("chunk", F.floor(F.col("part") / FAN_IN).alias("into")).applyInPandas(add, "part int, chunk int, met binary, moved binary")
        parts = -(-parts // FAN_IN)
        if parts <= 1:
            break
    embed, rest = net.embed.copy(), _rest(net)
    for r in moves.collect():    # the net's size
        met, moved = np.frombuffer(r["met"], np.int32), np.frombuffer(r["moved"], np.float32)
        if r["chunk"] < 0:
            rest = rest + moved / met[0]
        else:
            at = r["chunk"] * EMBEDDINGS
            embed[at: at + len(met)] += moved.reshape(len(met), -1) / np.maximum(met, 1)[:, None].astype(np.float32)
    filters, bias, at = [], [], 0
    for like, into in ((net.filters, filters), (net.bias, bias)):
        for w in like:
            into.append(rest[at: at + w.size].reshape(w.shape))
            at += w.size
    return Net(net.settings, embed, filters, bias, rest[at:-1], float(rest[-1]))


FILTER_WORDS = 1 << 20   # of ``among``, at most


def among(rows: DataFrame, known: DataFrame, n: int) -> DataFrame:
    """``rows`` without most of those whose hash ``h`` is not among the ``n`` of ``known``, before any shuffle.

    A hash sets one of 64 bits of a word of 8 hashes or more; the words are broadcast, 8 MB of bits at most. Some rows
    that are not known pass (about one in eight, more where the words are too few), so that a join has to follow.
    """
    words = max(1, min(-(-n // 8), FILTER_WORDS))
    word, bit = F.pmod("h", F.lit(words)).cast("int"), F.shiftrightunsigned("h", 58).cast("int")
    bits = known.select(word.alias("_word"), bit.alias("_bit")).groupBy("_word").agg(
        F.expr("bit_or(shiftleft(1L, _bit))").alias("_bits"))
    return rows.join(F.broadcast(bits), word == F.col("_word")).where(F.getbit("_bits", bit) == 1).drop("_word", "_bits")


def fit(labelled: DataFrame, settings: Settings | None = None, texts: DataFrame | None = None) -> Net | None:
    """Train on all (text, lang, label) rows, in parts of a bounded size.

    Rows are told apart by ``key``, where they have that column, text and label: copies of a text under several keys
    are trained on one by one; rows equal in all count once. Where ``labelled`` comes of a join, ``texts`` are the
    ``sized`` rows of it before that join: texts then go through one shuffle, coded, straight to their part, and meet
    their label there by ``h``; of ``labelled`` only hashes, sizes and labels are read.
    """
    s = settings or Settings()
    spark = labelled.sparkSession
    ship_package(spark)
    rows = labelled if "h" in labelled.columns else sized(labelled)
    known = rows.groupBy("h", "label").agg(F.max("chars").alias("chars"))
    if texts is not None:
        known = stored(known, "labelled")
    facts = known.groupBy("label").agg(F.count("*").alias("n"), F.sum("chars").alias("chars")).collect()   # a row a label
    if not facts:
        return None
    n, chars = sum(r["n"] for r in facts), sum(r["chars"] for r in facts)
    parts = max(1, -(-n // s.max_train_rows), -(-chars // s.max_train_chars))
    pair = np.dtype(np.uint16 if s.buckets < 1 << 16 else np.int32)

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at, end in _slices(b.column(0), 2 << 20):
                part = b.slice(at, end - at)
                codes, distinct, counts = coded_words(part.column(0), s.buckets)
                bounds = np.concatenate([[0], np.cumsum(counts) * 2 * pair.itemsize]).astype(np.int32)
                blobs = pa.Array.from_buffers(pa.binary(), len(counts), [None, pa.py_buffer(bounds),
                                                                         pa.py_buffer(np.ascontiguousarray(distinct.astype(pair)[codes]))])
                yield pa.RecordBatch.from_arrays([blobs, *part.columns[1:]], names=["ids", *b.schema.names[1:]])

    def wholes(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[tuple]]]:
        """The distinct rows of each part, in order of part and hash."""
        now, kept, last = None, [], None
        for b in batches:
            for r in zip(*[b.column(c).to_pylist() for c in ("part", "h", "label", "lang", "held", "ids")], strict=True):
                if r[0] != now:
                    if kept:
                        yield now, kept
                    now, kept, last = r[0], [], None
                if r[1:3] != last:
                    kept.append(r)
                last = r[1:3]
        if kept:
            yield now, kept

    def words(ids: bytes) -> np.ndarray:
        return np.frombuffer(ids, pair).reshape(-1, 2).astype(np.int32)

    part = F.pmod("h", F.lit(parts)).cast("int").alias("part")
    held = (F.pmod(F.shiftright("h", 32), F.lit(s.calibration)) == 0).alias("held")
    if texts is None:
        dealt = (rows.select("text", "lang", "h", part, held, "label").mapInArrow(coded, "ids binary, lang string, h long, part int, held boolean, label int")
                 .repartitionById(parts, F.col("part")))
    else:
        dealt = (among(texts, known, n).select("text", "lang", "h", part, held).mapInArrow(coded, "ids binary, lang string, h long, part int, held boolean")
                 .repartitionById(parts, F.col("part"))
                 .join(known.select("h", part, "label").repartitionById(parts, F.col("part")).hint("merge"), ["part", "h"]))
    dealt = dealt.sortWithinPartitions("part", "h", "label", F.col("lang").asc_nulls_last()).persist(StorageLevel.DISK_ONLY)
    try:
        taught = dealt.where(~F.col("held"))
        net = begun(sum(r["n"] for r in facts if r["label"]) / n, s)
        for k in range(s.epochs):

            def turn(batches: Iterator[pa.RecordBatch], net=net, k=k) -> Iterator[pa.RecordBatch]:
                for part, of in wholes(batches):
                    got = learn(net, [words(r[5]) for r in of], np.array([r[2] for r in of], np.float32), s.seed + 1000 * part + k, s.epochs)
                    chunk, met, moved = zip(*moves_of(net, got), strict=True)
                    yield pa.RecordBatch.from_arrays([pa.array([part] * len(chunk), pa.int32()), pa.array(chunk, pa.int32()),
                                                      pa.array(met, pa.binary()), pa.array(moved, pa.binary())], names=["part", "chunk", "met", "moved"])

            net = averaged(net, taught.mapInArrow(turn, "part int, chunk int, met binary, moved binary"), parts)

        def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            tables = response_tables(net)
            for _, of in wholes(batches):
                for at in range(0, len(of), 256):
                    some = of[at: at + 256]
                    texts = [words(r[5]) for r in some]
                    pairs = np.concatenate([np.zeros((0, 2), np.int32), *texts])
                    scores = score_texts(net, tables, np.arange(len(pairs)), pairs, np.array([len(x) for x in texts], np.int64))
                    yield pa.RecordBatch.from_arrays([pa.array([r[3] for r in some], pa.string()), pa.array(scores), pa.array(score_bin(scores)),
                                                      pa.array([r[2] for r in some], pa.int32())], names=["lang", "score", "bin", "label"])

        net.thresholds.update(best_thresholds(dealt.where("held").mapInArrow(judge, "lang string, score double, bin int, label int")))
    finally:
        dealt.unpersist()
    return net


def score(df: DataFrame, net: Net | None, carry: dict[str, Column], text: str = "text") -> DataFrame:
    """The ``carry`` columns (all by expression) and ``score`` of each row."""
    ship_package(df.sparkSession)
    source = df.select(*[c.alias(n) for n, c in carry.items()], F.col(text).alias("_scored_text"))
    if net is None:
        return source.drop("_scored_text").withColumn("score", F.lit(0.0))
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema.fields[:-1]] + ["score double"])
    names = [*carry, "score"]

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = response_tables(net)
        for b in batches:
            for at, end in _slices(b.column(b.num_columns - 1), 2 << 20):
                part = b.slice(at, end - at)
                got = score_texts(net, tables, *coded_words(part.column(part.num_columns - 1), net.settings.buckets))
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(got)], names=names)

    return source.mapInArrow(apply, schema)


def held_out(key: Column) -> Column:
    return F.pmod(F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")), F.lit(5)) == 0


def learnable_texts(docs: DataFrame) -> DataFrame:
    """(text, lang, h, chars, key) of the documents with an id that are not held out, labelled or not."""
    return sized(docs.where(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))).select(F.col("doc_id").alias("key"), "text", "lang"))


def labelled_texts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(key, text, lang, h, chars, label) of labelled documents that are not held out; of several labels of one document
    the largest. Sizes and hashes are taken before the join, so that a reader of those shuffles no text."""
    flags = labels.where("toxic IS NOT NULL AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").alias("label"))
    return learnable_texts(docs).join(flags.withColumnRenamed("doc_id", "key"), "key").withColumn("label", F.col("label").cast("int"))


def op6_toxicity_cnn(spark, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    net = fit(labelled_texts(docs, documents(spark, sf_dir, "labels")), texts=learnable_texts(docs))
    cut = net.thresholds if net else {"": 0.5}
    by_lang = F.create_map(*[F.lit(x) for kv in cut.items() for x in kv])
    got = score(docs, net, {"doc_id": F.col("doc_id"), "held_out": held_out(F.col("doc_id")),
                            "lang": F.coalesce(F.col("lang"), F.lit(""))})
    cutoff = F.coalesce(F.try_element_at(by_lang, F.col("lang")), F.lit(cut[""]))
    return got.select("doc_id", "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"),
                      (F.col("score") >= cutoff).alias("flagged_by_language"))
