"""How far the sources of a language differ in their words.

Frequencies come from single-pass in-memory indexing. Each task reads its
texts once and counts the postings (language, term, source) in a block in
memory; a full block is spilled as a run, sorted by term and cut by hash shard
of (language, term). The shuffle brings a shard's runs together, in order of
their first terms, and a heap merges them: a term is complete once every run
yet to come starts behind it. Terms in fewer documents
than asked for end there, so that the long tail of rare terms is shuffled as
compact runs and never again. Postings are summed before the shuffle: a word
that stands in every text costs one posting a run and source.

A term's smoothed rate in a group is ``p = 1 + floor(10**9 (count + 2) / (N + 2 V))``,
the divergence of two rates ``floor((p - q)**2 / (p + q))``. The sum over
all terms of a language starts as if no source had any of them, is
corrected by each source's counts against the others' zero rates (once a
distinct count), and then, term by term, by the pairs of sources that share
it: these stream through each task in blocks into sums a pair of sources.
All arithmetic is in whole numbers; rates are divided in three steps of a
thousand, exact for totals up to 9 * 10**15.

Null texts, languages and sources count as empty strings. Groups without terms
have rows too. Every row is a document, repeated ids included; other columns
are not read. An empty table has an empty result.
"""

from __future__ import annotations

import heapq
import zlib
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pylonflow.llm.common import documents, global_index, stored
from pylonflow.llm.decontaminate import _slices
from pylonflow.session import ship_package

BLOCK = 400_000            # postings a task holds before it spills a run
CHUNK = 2048               # terms a row of a run holds at most
SHARDS = 8                 # hash shards a partition of the shuffle
WINDOW = 1 << 22           # bytes of a text cut into words at a time
PAIRS = 1 << 20            # pairs of postings corrected at a time, and sums a task holds

# A-Z in lower case, letters and all bytes beyond ASCII as they are, a space for every other byte
_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
RUN = ("shard int, lang string, first binary, terms binary, docs binary, sizes binary, sources array<string>, "
       "who binary, counts binary")


def _words(text: bytes) -> Iterator[list[bytes]]:
    """The text's terms, a window of it at a time."""
    lo = 0
    while lo < len(text):
        cut = text.find(b" ", lo + WINDOW) if len(text) - lo > WINDOW else -1
        hi = cut if cut >= 0 else len(text)
        yield text[lo:hi].split()
        lo = hi


class _Block:
    """Postings of a task, by group: occurrences, and documents that hold the term."""

    def __init__(self):
        self.counts: dict[tuple[str, str], Counter] = {}
        self.docs: dict[str, Counter] = {}
        self.size = 0

    def add(self, lang: str, source: str, text: bytes) -> None:
        counts = self.counts.setdefault((lang, source), Counter())
        docs = self.docs.setdefault(lang, Counter())
        before, seen = len(counts) + len(docs), set()
        for words in _words(text):
            counts.update(words)
            new = set(words) - seen
            docs.update(new)
            if len(text) > WINDOW:
                seen |= new
        self.size += len(counts) + len(docs) - before

    def runs(self, shards: int) -> Iterator[dict]:
        """The block's run: rows of a shard and language, terms in order."""
        for lang, docs in self.docs.items():
            sources = sorted(s for l, s in self.counts if l == lang)
            salt, terms, n = zlib.crc32(lang.encode()), sorted(docs), len(docs)
            if not n:
                continue
            shard = np.fromiter((zlib.crc32(t, salt) for t in terms), np.int64, n) % shards
            order = np.argsort(shard, kind="stable")
            shard, terms = shard[order], [terms[k] for k in order.tolist()]
            place = dict(zip(terms, range(n), strict=True))
            held = [self.counts[lang, s] for s in sources]
            of = np.concatenate([np.fromiter(map(place.__getitem__, c), np.int64, len(c)) for c in held])
            order = np.argsort(of, kind="stable")
            who = np.repeat(np.arange(len(held), dtype=np.int32), [len(c) for c in held])[order]
            counts = np.concatenate([np.fromiter(c.values(), np.int64, len(c)) for c in held])[order]
            sizes = np.bincount(of, minlength=n).astype(np.int32)
            ends, in_docs = np.cumsum(sizes), np.fromiter(map(docs.__getitem__, terms), np.int64, n)
            starts = np.flatnonzero(np.concatenate([[True], shard[1:] != shard[:-1]]))
            for first, last in zip(starts, [*starts[1:], n], strict=True):
                for lo in range(first, last, CHUNK):
                    hi = min(lo + CHUNK, last)
                    own = slice(ends[lo] - sizes[lo], ends[hi - 1])
                    yield {"shard": int(shard[lo]), "lang": lang, "first": terms[lo], "terms": b" ".join(terms[lo:hi]),
                           "docs": in_docs[lo:hi].tobytes(), "sizes": sizes[lo:hi].tobytes(), "sources": sources,
                           "who": who[own].tobytes(), "counts": counts[own].tobytes()}


def _spilled(shards: int, block: int):
    schema = pa.schema([("shard", pa.int32()), ("lang", pa.string()), ("first", pa.binary()), ("terms", pa.binary()),
                        ("docs", pa.binary()), ("sizes", pa.binary()), ("sources", pa.list_(pa.string())),
                        ("who", pa.binary()), ("counts", pa.binary())])

    def spill(b: _Block) -> Iterator[pa.RecordBatch]:
        rows = []
        for row in b.runs(shards):
            rows.append(row)
            if len(rows) == 256:
                yield pa.RecordBatch.from_pylist(rows, schema=schema)
                rows = []
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema=schema)

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = _Block()
        for b in batches:
            for lo, hi in _slices(b.column(2), WINDOW):
                part = b.slice(lo, hi - lo)
                texts = part.column(2).cast(pa.binary()).to_pylist()
                for lang, source, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), texts, strict=True):
                    held.add(lang, source, text.translate(_BYTES))
                    if held.size >= block:
                        yield from spill(held)
                        held = _Block()
        yield from spill(held)

    return index


class _Cursor:
    """A place in one chunk of a run; cursors are ordered by their last term."""

    def __init__(self, row: dict):
        self.terms = row["terms"].split(b" ")
        self.docs = np.frombuffer(row["docs"], np.int64).tolist()
        self.row, self.at, self.last = row, 0, self.terms[-1]

    def __lt__(self, other: _Cursor) -> bool:
        return self.last < other.last

    def postings(self, lo: int, hi: int, wanted: set[bytes]) -> Iterator[tuple[bytes, str, int]]:
        """(term, source, occurrences) of the wanted ones among the terms ``lo`` to ``hi``."""
        found = [k for k in range(lo, hi) if self.terms[k] in wanted]
        if not found:
            return
        ends = np.cumsum(np.frombuffer(self.row["sizes"], np.int32)).tolist()
        who, counts = np.frombuffer(self.row["who"], np.int32), np.frombuffer(self.row["counts"], np.int64)
        for k in found:
            first, end = ends[k - 1] if k else 0, ends[k]
            for s, n in zip(who[first:end].tolist(), counts[first:end].tolist(), strict=True):
                yield self.terms[k], self.row["sources"][s], n


def _merged(chunks: Iterator[dict]) -> Iterator[tuple[int, str, list[tuple[_Cursor, int, int]]]]:
    """(shard, language, stretches of chunks) of chunks ordered by shard, language and first term.

    A heap holds the open chunks, the one that ends first on top. Once it ends before the next chunk begins, no chunk
    to come has a term below that beginning: what the open ones have there goes out together, every term whole.
    """
    heap: list[_Cursor] = []
    now = None

    def below(first: bytes | None):
        out = []
        for c in heap:
            hi = len(c.terms) if first is None else bisect_left(c.terms, first, c.at)
            if hi > c.at:
                out.append((c, c.at, hi))
            c.at = hi
        heap[:] = [c for c in heap if c.at < len(c.terms)]
        heapq.heapify(heap)
        return out

    for row in chunks:
        if (row["shard"], row["lang"]) != now:
            if heap:
                yield (*now, below(None))
            now = row["shard"], row["lang"]
        if heap and heap[0].last < row["first"]:
            yield (*now, below(row["first"]))
        heapq.heappush(heap, _Cursor(row))
    if heap:
        yield (*now, below(None))


def _frequencies(stretches: list[tuple[_Cursor, int, int]], min_docs: int) -> Iterator[tuple[bytes, dict[str, int]]]:
    """(term, occurrences by source), in order, of the terms that stand in ``min_docs`` documents."""
    docs: dict[bytes, int] = {}
    for c, lo, hi in stretches:
        for term, n in zip(c.terms[lo:hi], c.docs[lo:hi], strict=True):
            docs[term] = docs.get(term, 0) + n
    kept = sorted(t for t, n in docs.items() if n >= min_docs)
    counts: dict[bytes, dict[str, int]] = {t: {} for t in kept}
    wanted = set(kept)
    for c, lo, hi in stretches if kept else ():
        for term, source, n in c.postings(lo, hi, wanted):
            counts[term][source] = counts[term].get(source, 0) + n
    yield from counts.items()


def term_frequencies(df: DataFrame, lang: str = "lang", source: str = "source", text: str = "text", min_docs: int = 10,
                     block: int = BLOCK) -> DataFrame:
    """Stored (term_id, lang, term, total, sources, counts): the terms that stand in at least ``min_docs`` of their
    language's rows, with the occurrences in each source that has any."""
    spark = df.sparkSession
    ship_package(spark)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    text_of = lambda c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(""))
    rows = df.select(text_of(lang).alias("lang"), text_of(source).alias("source"), text_of(text).alias("text"))
    runs = rows.mapInArrow(_spilled(n * SHARDS, block), RUN)
    schema = pa.schema([("term_id", pa.int64()), ("lang", pa.string()), ("term", pa.string()), ("total", pa.int64()),
                        ("sources", pa.list_(pa.string())), ("counts", pa.list_(pa.int64()))])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunks = (row for b in batches for k in range(0, b.num_rows, 64) for row in b.slice(k, 64).to_pylist())
        out, shard, number = [], None, 0
        for at, lang_, stretches in _merged(chunks):
            if at != shard:
                shard, number = at, 0
            for term, counts in _frequencies(stretches, min_docs):
                number += 1
                out.append({"term_id": (shard << 40) + number, "lang": lang_, "term": term.decode(), "total": sum(counts.values()),
                            "sources": list(counts), "counts": list(counts.values())})
            if len(out) >= 4096:
                yield pa.RecordBatch.from_pylist(out, schema=schema)
                out = []
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=schema)

    return stored(runs.repartition(n, "shard").sortWithinPartitions("shard", "lang", "first")
                  .mapInArrow(merge, "term_id long, lang string, term string, total long, sources array<string>, counts array<long>"),
                  "frequencies")


def _rate(count: str, total: str) -> Column:
    """1 + floor(10**9 * (count + 2) / total), ``total`` at least ``count + 2``; null where it is 0."""
    d = f"nullif({total}, 0)"
    a = f"(({count}) + 2) * 1000L"
    b = f"(({a}) % {d}) * 1000L"
    return F.expr(f"1L + (({a}) div {d}) * 1000000L + (({b}) div {d}) * 1000L + ((({b}) % {d}) * 1000L) div {d}")


def _apart(p: str, q: str) -> str:
    return f"(((({p}) - ({q})) * (({p}) - ({q}))) div (({p}) + ({q})))"


def source_groups(df: DataFrame, frequencies: DataFrame, lang: str = "lang", source: str = "source") -> DataFrame:
    """Stored (group, lang, source, terms, total, zero, lang_total): every (language, source) that occurs, with its
    language's number of kept terms, its divisor N + 2 V and the rate of a term that it lacks."""
    text_of = lambda c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(""))
    there = df.select(text_of(lang).alias("lang"), text_of(source).alias("source")).distinct()
    own = (frequencies.select("lang", F.explode(F.arrays_zip("sources", "counts")).alias("x"))
           .groupBy("lang", F.col("x.sources").alias("source")).agg(F.sum("x.counts").alias("n")))
    langs = frequencies.groupBy("lang").agg(F.count("*").alias("terms"), F.sum("total").alias("lang_n"))
    groups = there.join(own, ["lang", "source"], "left").join(langs, "lang", "left").na.fill(0, ["n", "terms", "lang_n"])
    groups = groups.select("lang", "source", "terms", (F.col("n") + 2 * F.col("terms")).alias("total"),
                           (F.col("lang_n") + 2 * F.col("terms")).alias("lang_total"))
    return stored(global_index(groups.withColumn("zero", _rate("0L", "total")), ["lang", "source"], "group"), "groups")


def _postings(frequencies: DataFrame, groups: DataFrame) -> DataFrame:
    """(term_id, term, group, lang, source, zero, count, p, q): a row a term and group that has it."""
    x = frequencies.select("term_id", "lang", "term", F.col("total").alias("lang_count"),
                           F.explode(F.arrays_zip("sources", "counts")).alias("x"))
    x = x.select("term_id", "lang", "term", "lang_count", F.col("x.sources").alias("source"), F.col("x.counts").alias("count"))
    x = x.join(groups, ["lang", "source"])
    return x.select("term_id", "term", "group", "lang", "source", "zero", "count", _rate("count", "total").alias("p"),
                    _rate("lang_count", "lang_total").alias("q"))


def top_terms(postings: DataFrame, top: int = 10) -> DataFrame:
    """(lang, source, item, value, rank): a group's terms with a rate above their language's, furthest first."""
    best = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return (postings.where("p > q").select("lang", "source", F.col("term").alias("item"), F.expr(_apart("p", "q")).alias("value"))
            .withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top))


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Corrections a pair of groups, summed, of postings (term_id, group, p, zero) in order of term and group."""
    sums: dict[tuple[int, int], int] = {}

    def flush():
        pairs = np.array(list(sums), np.int64).reshape(-1, 2)
        out = pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1]), pa.array(list(sums.values()), pa.int64())],
                                         names=["a", "b", "value"])
        sums.clear()
        return out

    def apart(p, q):
        return (p - q) * (p - q) // (p + q)

    def add(term, group, p, zero):
        # row i meets the rows behind it in its term
        ends = np.searchsorted(term, term, "right")
        partners = ends - np.arange(len(term)) - 1
        upto = np.cumsum(partners)
        lo = 0
        while lo < len(term):
            hi = max(lo + 1, int(np.searchsorted(upto, (upto[lo - 1] if lo else 0) + PAIRS, "right")))
            i = np.repeat(np.arange(lo, hi), partners[lo:hi])
            j = i + 1 + np.arange(len(i)) - np.repeat(upto[lo:hi] - partners[lo:hi] - (upto[lo - 1] if lo else 0), partners[lo:hi])
            lo = hi
            if not len(i):
                continue
            value = apart(p[i], p[j]) - apart(p[i], zero[j]) - apart(zero[i], p[j]) + apart(zero[i], zero[j])
            order = np.lexsort((group[j], group[i]))
            a, b, value = group[i][order], group[j][order], value[order]
            first = np.flatnonzero(np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])]))
            for x, y, v in zip(a[first].tolist(), b[first].tolist(), np.add.reduceat(value, first).tolist(), strict=True):
                sums[x, y] = sums.get((x, y), 0) + v
            if len(sums) >= PAIRS:
                yield flush()

    rest = None
    for batch in batches:
        new = [batch.column(k).to_numpy() for k in range(4)]
        rows = new if rest is None else [np.concatenate(x) for x in zip(rest, new, strict=True)]
        if not len(rows[0]):
            continue
        cut = np.searchsorted(rows[0], rows[0][-1])     # the last term may go on
        yield from add(*[x[:cut] for x in rows])
        rest = [x[cut:] for x in rows]
    if rest is not None:
        yield from add(*rest)
    yield flush()


def pair_divergence(postings: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, source, item, value, rank): every other source of a language, furthest first."""
    spark = groups.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    both = (postings.select("term_id", "group", "p", "zero").repartition(n, "term_id").sortWithinPartitions("term_id", "group")
            .mapInArrow(_shared, "a long, b long, value long").groupBy("a", "b").agg(F.sum("value").alias("shared")))
    both = both.union(both.select("b", "a", "shared"))
    others = groups.select("lang", F.col("group").alias("b"), F.col("source").alias("item"), F.col("zero").alias("b_zero"))
    own = (postings.groupBy("lang", F.col("group").alias("a"), "p", F.col("zero").alias("a_zero")).agg(F.count("*").alias("n"))
           .join(others, "lang").where("a <> b").groupBy("a", "b")
           .agg(F.sum(F.expr(f"n * ({_apart('p', 'b_zero')} - {_apart('a_zero', 'b_zero')})")).alias("own")))
    pairs = (groups.select("lang", "source", "terms", F.col("group").alias("a"), F.col("zero").alias("a_zero"))
             .join(others, "lang").where("a <> b"))
    back = own.select(F.col("b").alias("a"), F.col("a").alias("b"), F.col("own").alias("theirs"))
    value = f"if(terms = 0, 0L, terms * {_apart('a_zero', 'b_zero')} + coalesce(own, 0L) + coalesce(theirs, 0L) + coalesce(shared, 0L))"
    rows = (pairs.join(own, ["a", "b"], "left").join(back, ["a", "b"], "left").join(both, ["a", "b"], "left")
            .select("lang", "source", "item", F.expr(value).alias("value")))
    furthest = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return rows.withColumn("rank", F.row_number().over(furthest))


def source_divergence(df: DataFrame, lang: str = "lang", source: str = "source", text: str = "text", min_docs: int = 10,
                      top: int = 10, block: int = BLOCK) -> DataFrame:
    """(lang, source, part, item, value, rank): part ``pair`` ranks each group's other sources of its language, part
    ``term`` the group's ``top`` terms against the language as a whole."""
    frequencies = term_frequencies(df, lang, source, text, min_docs, block)
    groups = source_groups(df, frequencies, lang, source)
    postings = _postings(frequencies, groups)
    parts = [("pair", pair_divergence(postings, groups)), ("term", top_terms(postings, top))]
    got = [rows.select("lang", "source", F.lit(part).alias("part"), "item", F.col("value").cast("long").alias("value"),
                       F.col("rank").cast("int").alias("rank")) for part, rows in parts]
    return got[0].unionByName(got[1])


def op13_source_divergence(spark, sf_dir: str) -> DataFrame:
    return source_divergence(documents(spark, sf_dir).select("lang", "source", "text"))


OP13_SQL = r"""
WITH docs AS (
  SELECT row_number() OVER () AS doc, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS words
  FROM documents),
words AS (SELECT doc, lang, source, unnest(words) AS term FROM docs),
kept AS (SELECT lang, term, count(*) AS c FROM words GROUP BY lang, term HAVING count(DISTINCT doc) >= 10),
groups AS (SELECT DISTINCT lang, source FROM docs),
counts AS (SELECT w.lang, w.source, w.term, count(*) AS c FROM words w JOIN kept USING (lang, term) GROUP BY ALL),
cells AS (SELECT g.lang, g.source, k.term, coalesce(c.c, 0) AS c, k.c AS lang_c
          FROM groups g JOIN kept k ON g.lang = k.lang
          LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
rates AS (SELECT lang, source, term, c,
            1 + (1000000000::HUGEINT * (c + 2)) // (sum(c) OVER w + 2 * count(*) OVER w) AS p,
            1 + (1000000000::HUGEINT * (lang_c + 2)) // (sum(lang_c) OVER w + 2 * count(*) OVER w) AS q
          FROM cells WINDOW w AS (PARTITION BY lang, source)),
pairs AS (SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS value
          FROM rates a JOIN rates b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
all_pairs AS (SELECT a.lang, a.source, b.source AS item, coalesce(p.value, 0) AS value
              FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
              LEFT JOIN pairs p ON p.lang = a.lang AND p.source = a.source AND p.item = b.source),
rows AS (SELECT lang, source, 'pair' AS part, item, value FROM all_pairs
         UNION ALL
         SELECT lang, source, 'term', term, ((p - q) * (p - q)) // (p + q) FROM rates WHERE c > 0 AND p > q),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM rows)
SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank FROM ranked WHERE part = 'pair' OR rank <= 10
"""
