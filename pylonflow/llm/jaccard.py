"""N-gram Jaccard join: documents linked where their shingle sets have a Jaccard similarity of 0.8 or more.

Sets that are equal are one class. The join of the classes goes by a
token-group matrix:

1. **Order.** A fixed-size count sketch of all shingles gives each a rarity
   level; (level, hash) is the order in which the tokens of a set are
   looked at. Any order is right; rare first makes lists short.
2. **Probe tokens.** If two sets of n tokens are linked they share at least
   80% of n, so the first ``n - ceil(0.8 n) + k`` tokens of each share ``k``.
   Only these enter the matrix, with ``k = 1 + n // 20``; tokens of one class
   only and classes with too few shared tokens drop out.
3. **Groups.** A class joins the group of its most shared probe token, which
   brings near copies together. A group's classes are linked exactly in
   one task (large groups in blocks), which yields components.
4. **Matrix.** Components are the groups from here on, and the matrix holds
   their token unions: (token, component). A token that lies in one
   component only cannot yield another link, and a class whose tokens
   reach other components fewer than ``k`` times cannot have one: that is the
   bound on query-group overlap.
5. **Opening.** Only what is left is opened: for each remaining token, classes
   of different components are compared by size and by parity bitmaps
   (their distance never exceeds the sets' difference), first the best pair
   of each two components, then, after merging, every pair that passes. All
   links are decided on whole sets.

Links inside one component are not all listed, but none between components
is lost: the components are those of the full link graph. Shingles are
64-bit hashes.

Null and empty texts have no shingles and are linked with nothing. Rows
with equal ids are told apart by their sets. A row without id takes no part
in links and has no component. Only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pylonflow.llm.common import documents, global_index, stored
from pylonflow.llm.components import connected_components
from pylonflow.llm.decontaminate import _slices, words_of
from pylonflow.session import ship_package

SHINGLE = 5
SKETCH_BITS = 21         # counters of the rarity sketch: 8 MB of counts, 2 MB of levels, whatever the corpus holds
SKETCH_CHUNKS = 32
BLOOM_BITS = 23          # bits of the filter before the last pass over the texts: 1 MB
BLOCK = 1024             # classes that one task compares with one another
SETS_A_TASK = 2000       # whole sets, and rows of token lists, that one call of the linking functions gets on average
TOKENS_A_TASK = 4_000_000     # and of their tokens: sets of 200,000 tokens come by twenties
ROWS_A_TASK = 20_000
SLICE_BYTES = 4 << 20

_BYTES = np.arange(256, dtype=np.uint8)
_SPACE = (_BYTES == 0x20) | ((_BYTES >= 0x09) & (_BYTES <= 0x0D))
_LOWER = np.where(_SPACE, 0x20, np.where((_BYTES >= 0x41) & (_BYTES <= 0x5A), _BYTES + 32, _BYTES)).astype(np.uint8)
_MUL, _MIX, _SALT = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F))


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _MIX
    x = (x ^ (x >> np.uint64(29))) * _MUL
    return x ^ (x >> np.uint64(32))


def shingle_sets(texts: pa.Array) -> list[np.ndarray]:
    """For each text its distinct shingles as sorted 64-bit hashes."""
    words, counts = words_of(texts, _LOWER)
    if not len(words):
        return [np.empty(0, np.uint64)] * len(counts)
    coded = words.dictionary_encode()
    table = np.fromiter(map(xxhash.xxh64_intdigest, coded.dictionary.to_pylist()), np.uint64, len(coded.dictionary))
    h = np.concatenate([table[coded.indices.to_numpy()], np.zeros(SHINGLE, np.uint64)])
    runs = {}   # hashes of the k words from each place on; k of a short text is its length
    acc = np.zeros(len(h) - SHINGLE, np.uint64)
    for k in range(1, SHINGLE + 1):
        acc = _mix(acc * _MUL + h[k - 1: k - 1 + len(acc)] + np.uint64(k))
        if k == SHINGLE or (counts == k).any():
            runs[k] = acc
    ends = np.cumsum(counts)
    out = []
    for end, n in zip(ends.tolist(), counts.tolist(), strict=True):
        if n == 0:
            out.append(np.empty(0, np.uint64))
        elif n < SHINGLE:
            out.append(runs[n][end - n: end - n + 1])
        else:
            out.append(np.unique(runs[SHINGLE][end - n: end - SHINGLE + 1]))
    return out


def least_overlap(n: int) -> int:
    """Tokens that a set of n shares with any set linked to it, at least."""
    return (4 * n + 4) // 5


def probe_depth(n: int) -> int:
    """Common probe tokens (k) that sets of n tokens are given room for."""
    return 1 + n // 20


def probe_tokens(tokens: np.ndarray, levels: np.ndarray) -> np.ndarray:
    n = len(tokens)
    level = levels[(tokens >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)]
    return tokens[np.argsort(level, kind="stable")][: n - least_overlap(n) + probe_depth(n)]


def _digest(tokens: np.ndarray) -> tuple[int, int]:
    with np.errstate(over="ignore"):
        pair = np.array([tokens.sum(dtype=np.uint64), _mix(tokens ^ _SALT).sum(dtype=np.uint64)], np.uint64)
    return tuple(pair.view(np.int64).tolist())


def parity_bitmap(tokens: np.ndarray) -> np.ndarray:
    """Parity of the tokens in each of a power of two of bits, at least as many as tokens, as 64-bit words.

    Folding halves on one another by exclusive or gives the bitmap of half the width.
    """
    bits = max(256, 1 << int(len(tokens) - 1).bit_length())
    odd = np.bincount((tokens & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.uint64)


def _rows(names: list[str], types: list, cols: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, t)
                                       for c, t in zip(cols, types, strict=True)], names=names)


def _sketch_and_digests(df: DataFrame, key: str, text: str) -> DataFrame:
    """One pass: a row with size and digest for each document, and each task's counters as compressed chunks."""
    kind = df.schema[key].dataType.simpleString()
    names = ["id", "n", "hi", "lo", "chunk", "counts"]
    types = [None, pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.binary()]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << SKETCH_BITS, np.uint32)
        id_type = None
        for b in batches:
            id_type = b.column(0).type
            for at, end in _slices(b.column(1), SLICE_BYTES):
                sets = shingle_sets(b.column(1).slice(at, end - at))
                every = np.concatenate(sets) if sets else np.empty(0, np.uint64)
                counts += np.bincount((every >> np.uint64(64 - SKETCH_BITS)).astype(np.int64),
                                      minlength=len(counts)).astype(np.uint32)
                pairs = [_digest(s) for s in sets]
                k = len(sets)
                yield _rows(names, types, [b.column(0).slice(at, end - at), [len(s) for s in sets],
                                           [p[0] for p in pairs], [p[1] for p in pairs], [None] * k, [None] * k])
        if counts.any():
            pack = zstandard.ZstdCompressor(level=1)
            blobs = [pack.compress(c.tobytes()) for c in np.split(counts, SKETCH_CHUNKS)]
            k = SKETCH_CHUNKS
            yield _rows(names, types, [pa.nulls(k, id_type), [None] * k, [None] * k, [None] * k, list(range(k)), blobs])

    return stored(df.select(F.col(key).alias("id"), F.col(text).alias("text")).mapInArrow(
        scan, f"id {kind}, n int, hi long, lo long, chunk int, counts binary"), "digests")


def _levels(scanned: DataFrame) -> np.ndarray:
    """Rarity level of each counter: a quarter of the binary logarithm's steps."""
    def add(g: pd.DataFrame) -> pd.DataFrame:
        unpack = zstandard.ZstdDecompressor()
        total = sum(np.frombuffer(unpack.decompress(x), np.uint32).astype(np.uint64) for x in g["counts"])
        level = np.minimum(255, 4 * np.log2(total.astype(float) + 1)).astype(np.uint8)
        return pd.DataFrame({"chunk": [g["chunk"].iloc[0]], "level": [level.tobytes()]})

    got = (scanned.where("chunk IS NOT NULL").select("chunk", "counts").groupBy("chunk")
           .applyInPandas(add, "chunk int, level binary").collect())   # 2 MB in all
    parts = {r["chunk"]: np.frombuffer(r["level"], np.uint8) for r in got}
    empty = np.zeros((1 << SKETCH_BITS) // SKETCH_CHUNKS, np.uint8)
    return np.concatenate([parts.get(k, empty) for k in range(SKETCH_CHUNKS)])


def _probe_rows(df: DataFrame, key: str, text: str, levels: np.ndarray) -> DataFrame:
    """(token, hi) of every class's probe tokens; a task sends equal sets once."""
    sent = df.sparkSession.sparkContext.broadcast(levels)

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done = set()
        for b in batches:
            for at, end in _slices(b.column(0), SLICE_BYTES):
                tokens, owners = [], []
                for s in shingle_sets(b.column(0).slice(at, end - at)):
                    if not len(s):
                        continue
                    hi, lo = _digest(s)
                    if (hi, lo) not in done:
                        done.add((hi, lo))
                        tokens.append(probe_tokens(s, sent.value))
                        owners.append(np.full(len(tokens[-1]), hi, np.int64))
                if tokens:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(tokens).view(np.int64)),
                                                      pa.array(np.concatenate(owners))], names=["token", "hi"])

    return df.where(F.col(key).isNotNull()).select(F.col(text).alias("text")).mapInArrow(probe, "token long, hi long")


def _shared_only(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by (token, hi): distinct rows of the tokens that more than one class has.

    A row is kept if its token is also the row's before or behind it; only the last row waits for the next batch.
    """
    token, hi, after = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, bool)
    for b in rows:
        token = np.concatenate([token, b.column(0).to_numpy()])
        hi = np.concatenate([hi, b.column(1).to_numpy()])
        if not len(token):
            continue
        new = np.ones(len(token), bool)
        new[1:] = (token[1:] != token[:-1]) | (hi[1:] != hi[:-1])
        token, hi = token[new], hi[new]
        same = token[1:] == token[:-1]
        after = np.concatenate([after if len(after) else [False], same])   # the same token as the row before
        keep = after[:-1] | same
        yield pa.RecordBatch.from_arrays([pa.array(token[:-1][keep]), pa.array(hi[:-1][keep])], names=["token", "hi"])
        token, hi, after = token[-1:], hi[-1:], after[-1:]
    yield pa.RecordBatch.from_arrays([pa.array(token[after]), pa.array(hi[after])], names=["token", "hi"])


def linked(a: np.ndarray, b: np.ndarray) -> bool:
    """Exact: 100 * intersection >= 80 * union."""
    if len(a) > len(b):
        a, b = b, a
    if not len(a):
        return False
    at = np.searchsorted(b, a)
    both = int((b[np.minimum(at, len(b) - 1)] == a).sum())
    return 100 * both >= 80 * (len(a) + len(b) - both)


class _Bitmaps:
    """Bitmaps of rows sorted by size, compared at the width of the smaller set."""

    def __init__(self, n: np.ndarray, maps: list[bytes]):
        self.n = n
        self.width = np.array([len(m) // 8 for m in maps])
        self.at: dict[int, np.ndarray] = {}
        folded = [np.frombuffer(m, np.uint64) for m in maps]
        for w in sorted(set(self.width.tolist()), reverse=True):
            folded = [f if f is None or len(f) <= w else self._fold(f, w) for f in folded]
            table = np.zeros((len(maps), w), np.uint64)
            for k, f in enumerate(folded):
                if len(f) == w:
                    table[k] = f
            self.at[w] = table

    @staticmethod
    def _fold(f: np.ndarray, w: int) -> np.ndarray:
        while len(f) > w:
            f = f[: len(f) // 2] ^ f[len(f) // 2:]
        return f

    def near(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        """Rows behind i that may be linked with it, and lower bounds of their sets' difference."""
        end = int(np.searchsorted(self.n, 5 * self.n[i] // 4, "right"))
        table = self.at[int(self.width[i])]
        apart = np.bitwise_count(table[i + 1: end] ^ table[i]).sum(1, dtype=np.int64)
        ok = np.flatnonzero(9 * apart <= self.n[i] + self.n[i + 1: end])
        return ok + i + 1, apart[ok]


def _parts(keys: np.ndarray) -> Iterator[np.ndarray]:
    """Row numbers of each distinct key."""
    order = np.argsort(keys, kind="stable")
    cuts = np.flatnonzero(np.diff(keys[order])) + 1
    return iter(np.split(order, cuts)) if len(keys) else iter(())


def _star(cid: np.ndarray, n: np.ndarray, sets: list[bytes], maps: list[bytes]) -> list[tuple[int, int]]:
    """(class, smallest class of its component) among the given classes, by whole sets."""
    order = np.lexsort((cid, n))
    cid, n = cid[order], n[order]
    sets = [np.frombuffer(sets[k], np.uint64) for k in order]
    bitmaps, label = _Bitmaps(n, [maps[k] for k in order]), np.arange(len(cid))
    for i in range(len(cid)):
        rows, apart = bitmaps.near(i)
        for j in rows[np.argsort(apart, kind="stable")].tolist():
            if label[i] != label[j] and linked(sets[i], sets[j]):
                label[label == label[j]] = label[i]
    root: dict[int, int] = {}
    for k, c in zip(label.tolist(), cid.tolist(), strict=True):
        root[k] = min(c, root.get(k, c))
    return [(c, root[k]) for k, c in zip(label.tolist(), cid.tolist(), strict=True) if root[k] != c]


def _link_groups(g: pd.DataFrame) -> pd.DataFrame:
    cid, n = g["cid"].to_numpy(np.int64), g["n"].to_numpy(np.int64)
    sets, maps, out = g["tokens"].to_numpy(), g["bitmap"].to_numpy(), []
    for rows in _parts(g["home"].to_numpy(np.int64)):
        if len(rows) > 1:
            out += _star(cid[rows], n[rows], sets[rows], maps[rows])
    return pd.DataFrame(out, columns=["a", "b"], dtype=np.int64)


def _open_lists(every: bool):
    """Pairs of different components that share a token and may be linked: all of them, or of each two components
    in a list the nearest."""
    def look(g: pd.DataFrame) -> pd.DataFrame:
        cids, comps, sizes, blocks = (g[c].to_numpy(np.int64) for c in ("cid", "component", "n", "block"))
        bitmaps, pairs = g["bitmap"].to_numpy(), set()
        for part in _parts(g["token"].to_numpy(np.int64)):
            order = part[np.lexsort((cids[part], sizes[part]))]
            cid, comp, n, block = cids[order], comps[order], sizes[order], blocks[order]
            two, best = block.min() != block.max(), {}
            if comp.min() == comp.max():
                continue
            maps = _Bitmaps(n, bitmaps[order])
            for i in range(len(cid)):
                rows, apart = maps.near(i)
                ok = comp[rows] != comp[i]
                if two:
                    ok &= block[rows] != block[i]
                for j, d in zip(rows[ok].tolist(), apart[ok].tolist(), strict=True):
                    pair = (min(cid[i], cid[j]), max(cid[i], cid[j]))
                    if every:
                        pairs.add(pair)
                    else:
                        at, score = (min(comp[i], comp[j]), max(comp[i], comp[j])), d / (n[i] + n[j])
                        if at not in best or (score, pair) < best[at]:
                            best[at] = (score, pair)
            pairs.update(p for _, p in best.values())
        return pd.DataFrame(sorted(pairs), columns=["a", "b"], dtype=np.int64)
    return look


def _verified(pairs: DataFrame, full: DataFrame) -> DataFrame:
    """The pairs whose whole sets are linked."""
    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            left, right = b.column(2).to_pylist(), b.column(3).to_pylist()
            ok = [linked(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)) for x, y in zip(left, right, strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1)], names=["a", "b"]).filter(pa.array(ok, pa.bool_()))

    one = full.select(F.col("cid").alias("a"), F.col("tokens").alias("x"))
    two = full.select(F.col("cid").alias("b"), F.col("tokens").alias("y"))
    return pairs.join(one, "a").join(two, "b").select("a", "b", "x", "y").mapInArrow(check, "a long, b long")


def _whole_sets(df: DataFrame, key: str, text: str, wanted: DataFrame) -> DataFrame:
    """(cid, n, tokens, bitmap) of the wanted classes, from their representatives' texts.

    A bit field of the wanted ids, of fixed size, keeps most other texts out of the shuffle.
    """
    bit = F.pmod(F.xxhash64("id"), F.lit(1 << BLOOM_BITS))
    set_bits = (wanted.select(bit.alias("bit")).groupBy(F.shiftright("bit", 6).cast("int").alias("word"))
                .agg(F.bit_or(F.expr("shiftleft(1L, CAST(bit % 64 AS INT))")).alias("bits")).collect())
    field = np.zeros(1 << (BLOOM_BITS - 6), np.int64)
    for r in set_bits:
        field[r["word"]] = r["bits"]
    sent = df.sparkSession.sparkContext.broadcast(field)
    kind = df.schema[key].dataType.simpleString()

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at = b.column(1).to_numpy()
            b = b.filter(pa.array((sent.value[at >> 6] >> (at & 63)) & 1 == 1))
            for lo, hi in _slices(b.column(2), SLICE_BYTES):
                part = shingle_sets(b.column(2).slice(lo, hi - lo))
                digests = [_digest(s) for s in part]
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(lo, hi - lo), pa.array([d[0] for d in digests], pa.int64()),
                     pa.array([d[1] for d in digests], pa.int64()), pa.array([s.tobytes() for s in part], pa.binary()),
                     pa.array([parity_bitmap(s).tobytes() if len(s) else b"" for s in part], pa.binary())],
                    names=["id", "hi", "lo", "tokens", "bitmap"])

    rows = (df.select(F.col(key).alias("id"), F.col(text).alias("text")).where("id IS NOT NULL")
            .select("id", bit.alias("bit"), "text")
            .mapInArrow(sets, f"id {kind}, hi long, lo long, tokens binary, bitmap binary"))
    got = rows.join(wanted, ["id", "hi", "lo"]).select("cid", "n", "tokens", "bitmap").dropDuplicates(["cid"])
    return stored(got, "sets")


def _able(lists: DataFrame) -> DataFrame:
    """Classes with as many listed tokens as a linked class must share with them (see ``probe_depth``)."""
    least = F.lit(1) + F.floor(F.floor((4 * F.col("n") + 4) / 5) / 20)
    return (lists.groupBy("cid").agg(F.count("*").alias("c"), F.first("n").alias("n")).where(F.col("c") >= least)
            .select("cid"))


def _task(key: str, rows: DataFrame, a_task: int):
    """Tasks take many small groups each, about ``a_task`` rows; the blocks of a large group are tasks of their own."""
    return F.pmod(F.xxhash64(key), F.lit(max(1, rows.count() // a_task)))


def _distinct_lists(lists: DataFrame) -> DataFrame:
    """One token of those that have the same classes, with the number of blocks of its list."""
    alike = lists.groupBy("token").agg(F.bit_xor(F.xxhash64("cid")).alias("x"), F.bit_xor(F.xxhash64("cid", F.lit(1))).alias("y"),
                                       F.count("*").alias("m"))
    one = alike.groupBy("x", "y", "m").agg(F.min("token").alias("token"))
    return lists.join(one.select("token", F.ceil(F.col("m") / BLOCK).cast("int").alias("blocks")), "token")


def jaccard_components(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, n_shingles, component) of every row: the smallest id that links reach."""
    ship_package(df.sparkSession)
    scanned = _sketch_and_digests(df, key, text)
    rows = scanned.where("chunk IS NULL").select("id", "n", "hi", "lo")
    classes = global_index(rows.where("n > 0 AND id IS NOT NULL").groupBy("hi", "lo", "n").agg(F.min("id").alias("id")),
                           ["id", "hi", "lo"], "cid")   # a class's number follows its smallest id
    classes = stored(classes, "classes")

    probes = _probe_rows(df, key, text, _levels(scanned))
    lists = stored(probes.repartition("token").sortWithinPartitions("token", "hi")
                   .mapInArrow(_shared_only, "token long, hi long"), "lists")
    lists = lists.join(classes.select("hi", "cid", "n"), "hi").select("token", "cid", "n")
    for _ in range(2):   # classes with too few shared tokens leave, then tokens left with one class
        kept = lists.select("token", "cid", "n").join(_able(lists), "cid", "left_semi")
        many = kept.groupBy("token").agg(F.count("*").alias("df")).where("df > 1")
        lists = stored(kept.join(many, "token"), "lists")

    # groups: by the most shared token of each class
    home = lists.groupBy("cid").agg(F.max(F.struct("df", F.xxhash64("token").alias("h"), "token")).alias("top"))
    home = home.select("cid", F.col("top.token").alias("home"))
    full = _whole_sets(df, key, text, classes.join(home, "cid", "left_semi"))
    sized = home.join(classes.select("cid", "n"), "cid")
    each = sized.agg(F.avg("n")).first()[0] or 1
    sizes = sized.groupBy("home").agg(F.ceil(F.greatest(F.count("*") / BLOCK, F.sum("n") / TOKENS_A_TASK)).alias("blocks"))
    grouped = home.join(sizes, "home").select(
        "cid", "home", F.pmod(F.xxhash64("cid"), F.col("blocks")).alias("block"), _task("home", home, max(1, min(SETS_A_TASK, int(TOKENS_A_TASK / each)))).alias("task"))
    links = stored(full.join(grouped, "cid").groupBy("task", "block").applyInPandas(_link_groups, "a long, b long"), "links")

    # matrix of tokens and components, then opening
    marks = full.select("cid", "bitmap")
    for every in (False, True):
        comps = connected_components(links)
        open_lists = lists.join(comps.withColumnRenamed("id", "cid"), "cid", "left").select(
            "token", "cid", "n", F.coalesce("component", "cid").alias("component"))
        for _ in range(2):
            wide = (open_lists.groupBy("token").agg(F.min("component").alias("low"), F.max("component").alias("high"))
                    .where("low < high").select("token"))
            open_lists = stored(open_lists.join(wide, "token", "left_semi"), "open")
            open_lists = open_lists.join(_able(open_lists), "cid", "left_semi")
        open_lists = stored(open_lists, "open")
        placed = stored(_distinct_lists(open_lists), "open")
        placed = (placed.withColumn("task", _task("token", placed, ROWS_A_TASK)).withColumn("block", F.pmod(F.xxhash64("cid"), F.col("blocks")).cast("int"))
                  .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
                  .join(marks, "cid"))
        placed = placed.select("token", "cid", "component", "n", "bitmap", "block", "task",
                               F.least("block", "other").alias("b0"), F.greatest("block", "other").alias("b1"))
        pairs = placed.groupBy("task", "b0", "b1").applyInPandas(_open_lists(every), "a long, b long").distinct()
        links = stored(links.unionByName(_verified(stored(pairs, "pairs"), full)), "links")
    comps = connected_components(links)

    ids = classes.select(F.col("cid").alias("component"), F.col("id").alias("component_id"))
    named = (classes.join(comps.withColumnRenamed("id", "cid"), "cid", "left")
             .withColumn("component", F.coalesce("component", "cid")).join(ids, "component")
             .select("hi", "lo", "n", "component_id"))
    able = F.col("id").isNotNull() & (F.col("n") > 0)
    linked_rows = rows.where(able).join(named, ["hi", "lo", "n"]).select("id", F.col("n").cast("long").alias("n_shingles"), "component_id")
    rest = rows.where(~able).select("id", F.col("n").cast("long").alias("n_shingles"), F.col("id").alias("component_id"))
    return linked_rows.unionByName(rest)


def op8_jaccard_join(spark, sf_dir: str) -> DataFrame:
    return jaccard_components(documents(spark, sf_dir)).withColumnRenamed("id", "doc_id").select(
        "doc_id", "n_shingles", "component_id")


OP8_SQL = r"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                       'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
g AS (SELECT DISTINCT doc_id, array_to_string(list_slice(w, i, i + 4), ' ') AS sh
      FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id),
pair AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM g a JOIN g b ON a.sh = b.sh AND a.doc_id < b.doc_id GROUP BY ALL),
link AS (SELECT a, b FROM pair JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 80 * (x.n + y.n - c)),
edge AS (SELECT a, b FROM link UNION ALL SELECT b, a FROM link),
reach AS (SELECT doc_id AS a, doc_id AS b FROM d UNION SELECT reach.a, edge.b FROM reach JOIN edge ON edge.a = reach.b)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, r.component_id
FROM d LEFT JOIN n USING (doc_id) JOIN (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a) r USING (doc_id)
"""
