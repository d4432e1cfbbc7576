"""Benchmark decontamination on a distributed positional inverted index.

``build_index`` cuts the corpus into segments of bounded size. Within its
task a segment becomes one stored row a term: the term, its number of
occurrences and the delta-coded positions, where the segment's documents
lie one after another with a gap of one position between them, so that no
phrase runs from one document into the next. The index holds every word of
every text and serves any later set of test phrases.

``search`` takes test phrases in blocks of bounded size. A block's terms
select posting lists; each segment then answers the block on its own. A
phrase starts from the positions of its rarest term in the segment, shifted
by that term's offset, and is intersected with the offset-adjusted lists of
the other terms, rarest first, until nothing or the whole phrase is left.
``proximity`` asks instead for all terms of a phrase inside a span of words.

Nothing is shuffled to build the index, and a search shuffles only the posting
lists of test terms, by segment: segments are of equal size whatever words
or sources are common.

Null texts and empty texts have no words; every input row gives one output
row, repeated ids included; a null item id reads as the empty string.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pylonflow.llm.common import LOWER, UPPER, documents, stored
from pylonflow.session import ship_package

ALNUM_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"   # after lower-casing A-Z: digits, a-z, everything beyond ASCII
SEGMENT_BYTES = 8 << 20
BLOCK_PHRASES = 50_000
INDEX_SCHEMA = "segment string, term binary, n int, positions binary, doc int, key string, n_words int"

# Byte table: A-Z lower-cased, word bytes kept, all others a space.
_BYTES = np.arange(256, dtype=np.uint8)
_IS_WORD = ((_BYTES >= 0x30) & (_BYTES <= 0x39)) | ((_BYTES >= 0x61) & (_BYTES <= 0x7A)) | (_BYTES >= 0x80)
_CLEAN = np.where((_BYTES >= 0x41) & (_BYTES <= 0x5A), _BYTES + 32, np.where(_IS_WORD, _BYTES, 0x20)).astype(np.uint8)


def words_of(texts: pa.Array, clean_table: np.ndarray = _CLEAN) -> tuple[pa.Array, np.ndarray]:
    """All words of an array of texts, one after another, and each text's number of words.

    ``clean_table`` maps every byte to itself, to its lower case, or to a space if it parts words.
    """
    raw = pc.fill_null(texts.cast(pa.large_binary()), b"")
    offsets = np.frombuffer(raw.buffers()[1], np.int64)[raw.offset: raw.offset + len(raw) + 1]
    if not len(raw) or raw.buffers()[2] is None or offsets[0] == offsets[-1]:
        return pa.array([], pa.binary()), np.zeros(len(raw), np.int64)
    clean = clean_table[np.frombuffer(raw.buffers()[2], np.uint8)[offsets[0]: offsets[-1]]]
    offsets = offsets - offsets[0]
    word = clean != 0x20
    before = np.empty(len(word), bool)
    before[0], before[1:] = False, word[:-1]
    firsts = offsets[:-1][offsets[:-1] < len(word)]
    before[firsts] = False               # a text's first byte starts a word whatever came before it
    starts = np.flatnonzero(word & ~before)
    packed = np.concatenate([[0], np.cumsum(word)])   # word bytes up to a byte
    bounds = np.append(packed[starts], packed[-1]).astype(np.int32)
    words = pa.Array.from_buffers(pa.binary(), len(starts),
                                  [None, pa.py_buffer(bounds), pa.py_buffer(np.ascontiguousarray(clean[word]))])
    return words, np.diff(np.searchsorted(starts, offsets))


def _slices(texts: pa.Array, limit: int) -> Iterator[tuple[int, int]]:
    """Runs of rows of about ``limit`` bytes (a longer text is a run of its own)."""
    size = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False))
    at = 0
    while at < len(texts):
        done = size[at - 1] if at else 0
        end = max(at + 1, int(np.searchsorted(size, done + limit, "right")))
        yield at, end
        at = end


def _segment_rows(name: str, keys: pa.Array, texts: pa.Array) -> Iterator[pa.RecordBatch]:
    words, counts = words_of(texts)
    n_docs = len(counts)
    names = ["segment", "term", "n", "positions", "doc", "key", "n_words"]
    yield pa.RecordBatch.from_arrays(
        [pa.array([name] * n_docs), pa.nulls(n_docs, pa.binary()), pa.nulls(n_docs, pa.int32()),
         pa.nulls(n_docs, pa.binary()), pa.array(np.arange(n_docs, dtype=np.int32)), keys,
         pa.array(counts.astype(np.int32))], names=names)
    if not len(words):
        return
    coded = words.dictionary_encode()
    codes = coded.indices.to_numpy()
    place = (np.arange(len(codes)) + np.repeat(np.arange(n_docs), counts)).astype(np.int32)
    order = np.argsort(codes, kind="stable")
    df = np.bincount(codes, minlength=len(coded.dictionary))
    ends = np.cumsum(df)
    deltas = np.diff(place[order], prepend=np.int32(0))
    firsts = ends - df
    deltas[firsts] = place[order][firsts]
    bounds = np.concatenate([[0], ends * 4]).astype(np.int32)
    lists = pa.Array.from_buffers(pa.binary(), len(df), [None, pa.py_buffer(bounds), pa.py_buffer(np.ascontiguousarray(deltas))])
    k = len(df)
    yield pa.RecordBatch.from_arrays(
        [pa.array([name] * k), coded.dictionary, pa.array(df.astype(np.int32)), lists, pa.nulls(k, pa.int32()),
         pa.nulls(k, pa.string()), pa.nulls(k, pa.int32())], names=names)


def build_index(df: DataFrame, key: str = "doc_id", text: str = "text", segment_bytes: int = SEGMENT_BYTES) -> DataFrame:
    """The stored index of all texts: posting rows, and a row without term for each document."""
    ship_package(df.sparkSession)

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, k = TaskContext.get().partitionId(), 0
        for batch in batches:
            keys, texts = batch.column(0), batch.column(1)
            for at, end in _slices(texts, segment_bytes):
                yield from _segment_rows(f"{task:06d}-{k:06d}", keys.slice(at, end - at), texts.slice(at, end - at))
                k += 1

    narrow = df.select(F.col(key).cast("string").alias("key"), F.col(text).alias("text"))
    return stored(narrow.mapInArrow(index, INDEX_SCHEMA), "index")


def phrases_of(df: DataFrame, key: str = "item_id", text: str = "text", window: int = 10) -> DataFrame:
    """(phrase, item) rows: every window of ``window`` consecutive words, or all words of a shorter text."""
    words = F.regexp_extract_all(F.translate(F.col(text), UPPER, LOWER), F.lit(f"({ALNUM_WORD})"), F.lit(1))
    items = df.select(F.coalesce(F.col(key).cast("string"), F.lit("")).alias("item"), words.alias("w")).where(F.size("w") > 0)
    cut = F.transform(F.sequence(F.lit(1), F.greatest(F.size("w") - (window - 1), F.lit(1))),
                      lambda i: F.slice(F.col("w"), i, window))
    return items.select("item", F.explode(cut).alias("phrase")).distinct()


class _Lists:
    """Posting lists of a segment, decoded when first used."""

    def __init__(self, terms, positions):
        self.raw = dict(zip(terms, positions, strict=True))
        self.seen: dict[bytes, np.ndarray] = {}

    def __getitem__(self, term: bytes) -> np.ndarray:
        if term not in self.seen:
            self.seen[term] = np.cumsum(np.frombuffer(self.raw[term], np.int32), dtype=np.int64)
        return self.seen[term]


def phrase_starts(phrase: list[bytes], lists: _Lists) -> np.ndarray:
    """First positions of the exact occurrences of ``phrase``."""
    if any(t not in lists.raw for t in phrase):
        return np.empty(0, np.int64)
    plan = sorted(range(len(phrase)), key=lambda k: len(lists.raw[phrase[k]]))
    starts = lists[phrase[plan[0]]] - plan[0]
    for k in plan[1:]:
        other = lists[phrase[k]]
        at = np.searchsorted(other, starts + k)
        starts = starts[other[np.minimum(at, len(other) - 1)] == starts + k]
        if not len(starts):
            break
    return starts


def near_spans(phrase: list[bytes], lists: _Lists, span: int, doc_starts: np.ndarray) -> list[tuple[int, int]]:
    """Shortest stretches [first, last] of at most ``span`` words of one document that hold all terms, one for
    each occurrence of the rarest term that has any."""
    terms = sorted(set(phrase), key=lambda t: len(lists.raw.get(t, b"")))
    if not terms or any(t not in lists.raw for t in terms):
        return []
    out = set()
    for p in lists[terms[0]]:
        doc = np.searchsorted(doc_starts, p, "right")
        low = max(p - span + 1, doc_starts[doc - 1])
        high = min(p + span, doc_starts[doc] - 1 if doc < len(doc_starts) else p + span)
        near = []
        for k, t in enumerate(terms):
            at = lists[t]
            near += [(int(x), k) for x in at[np.searchsorted(at, low): np.searchsorted(at, high)]] if k else [(int(p), 0)]
        near.sort()
        best, count, left = None, [0] * len(terms), 0
        for x, k in near:
            count[k] += 1
            while all(count):
                if best is None or x - near[left][0] < best[1] - best[0]:
                    best = (near[left][0], x)
                count[near[left][1]] -= 1
                left += 1
        if best and best[1] - best[0] < span:
            out.add(best)
    return sorted(out)


def _answer(segment: pd.DataFrame, phrases: list[tuple[list[bytes], list[str]]], span: int | None, every: bool) -> pd.DataFrame:
    docs = segment[segment["term"].isna()].sort_values("doc")
    posts = segment[segment["term"].notna()]
    counts = docs["n_words"].to_numpy(np.int64)
    starts = np.concatenate([[0], np.cumsum(counts + 1)])   # a document's first position; the last is the end
    lists = _Lists(posts["term"], posts["positions"])
    change = np.zeros(int(starts[-1]) + 1, np.int32)
    items: dict[int, set] = {}
    for phrase, owners in phrases:
        if span is None:
            first = phrase_starts(phrase, lists)
            last = first + len(phrase)
        else:
            got = near_spans(phrase, lists, span, starts[:-1])
            first = np.array([a for a, _ in got], np.int64)
            last = np.array([b + 1 for _, b in got], np.int64)
        if len(first):
            np.add.at(change, first, 1)
            np.add.at(change, last, -1)
            for d in np.unique(np.searchsorted(starts, first, "right") - 1).tolist():
                items.setdefault(d, set()).update(owners)
    hit = np.concatenate([[0], np.cumsum(np.cumsum(change)[:-1] > 0)])
    n_hit = hit[starts[1:]] - hit[starts[:-1]]
    rows = []
    for k, (key, n) in enumerate(zip(docs["key"], counts.tolist(), strict=True)):
        if n_hit[k] or every:
            at = (np.flatnonzero(np.diff(hit[starts[k]: starts[k + 1] + 1])) if n_hit[k] else np.empty(0)).astype(np.int32)
            rows.append((segment["segment"].iloc[0], k, key, n, at.tobytes(), sorted(items.get(k, ()))))
    return pd.DataFrame(rows, columns=["segment", "doc", "key", "n_words", "hits", "items"])


def _answering(phrases: list, span: int | None, every: bool):
    return lambda segment: _answer(segment, phrases, span, every)


def _merge(rows: pd.DataFrame) -> pd.DataFrame:
    """One row a document from its rows of all blocks of phrases."""
    out = []
    for _, g in rows.groupby("doc", sort=True):
        at = np.unique(np.concatenate([np.frombuffer(x, np.int32) for x in g["hits"]]))
        items = sorted({i for x in g["items"] for i in x})
        out.append((g["key"].iloc[0], int(g["n_words"].iloc[0]), len(at), items, at.tolist()))
    return pd.DataFrame(out, columns=["key", "n_words", "n_hit", "items", "positions"])


def search(index: DataFrame, phrases: DataFrame, proximity: int | None = None,
           block_phrases: int = BLOCK_PHRASES) -> DataFrame:
    """(key, n_words, n_hit, items, positions) of every indexed document.

    ``phrases`` has (phrase array<string>, item string) rows. They are taken in
    blocks of about ``block_phrases`` phrases: only one block is ever on the
    driver or in a task, however long the test set is. ``positions`` are the
    document's word numbers inside any match, exact phrases by default, spans
    of at most ``proximity`` words holding all terms otherwise.
    """
    ship_package(index.sparkSession)
    phrases = stored(phrases.groupBy("phrase").agg(F.collect_set("item").alias("items"))
                     .withColumn("h", F.xxhash64("phrase")), "phrases")
    blocks = max(1, -(-phrases.count() // block_phrases))
    parts = []
    for b in range(blocks):
        mine = phrases.where(F.pmod("h", F.lit(blocks)) == b)
        listed = [([t.encode() for t in r["phrase"]], list(r["items"])) for r in mine.collect()]
        terms = mine.select(F.explode("phrase").alias("t")).select(F.col("t").cast("binary").alias("term")).distinct()
        # a block holds at most block_phrases * window terms: small enough to send to every task
        posts = index.join(F.broadcast(terms), "term", "left_semi").unionByName(index.where("term IS NULL"))
        parts.append(posts.groupBy("segment").applyInPandas(
            _answering(listed, proximity, every=b == 0),
            "segment string, doc int, key string, n_words long, hits binary, items array<string>"))
    found = parts[0]
    for p in parts[1:]:
        found = found.unionByName(p)
    return found.groupBy("segment").applyInPandas(
        _merge, "key string, n_words long, n_hit long, items array<string>, positions array<int>")


def contamination(df: DataFrame, bench: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id",
                  item_text: str = "text", window: int = 10) -> DataFrame:
    """``search`` for all windows of the benchmark over an index of ``df``."""
    return search(build_index(df, key, text), phrases_of(bench, item, item_text, window))


def digest(items: list[str]) -> str:
    return sha256(",".join(sorted(items)).encode()).hexdigest()


def op1_decontamination(spark, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    got = contamination(docs, documents(spark, sf_dir, "benchmark"))
    ids = F.array_join(F.array_sort("items"), ",")
    return got.select(F.col("key").cast(docs.schema["doc_id"].dataType).alias("doc_id"), "n_words", "n_hit",
                      F.size("items").cast("long").alias("n_items"), F.sha2(ids, 256).alias("items_sha256"),
                      (F.col("n_hit") > 0).alias("contaminated"))


OP1_SQL = r"""
WITH dw AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(translate(coalesce(text, ''),
              'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
bw AS (SELECT coalesce(item_id::VARCHAR, '') AS item, regexp_extract_all(translate(coalesce(text, ''),
              'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
win AS (SELECT DISTINCT item, len(p) AS n, array_to_string(p, ' ') AS p FROM
          (SELECT item, list_slice(w, i, i + 9) AS p FROM
             (SELECT item, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM bw WHERE len(w) > 0))),
lens AS (SELECT DISTINCT n FROM win),
dg AS (SELECT rid, i, n, array_to_string(list_slice(w, i, i + n - 1), ' ') AS p FROM
         (SELECT rid, w, unnest(range(1, len(w) + 1)) AS i FROM dw), lens WHERE i + n - 1 <= len(w)),
m AS (SELECT rid, i, dg.n, item FROM dg JOIN win USING (n, p)),
hit AS (SELECT rid, count(DISTINCT i + k) AS c FROM (SELECT DISTINCT rid, i, n FROM m),
          (SELECT unnest(range(10)) AS k) WHERE k < n GROUP BY rid),
it AS (SELECT rid, count(*) AS c, string_agg(item, ',' ORDER BY item) AS s FROM (SELECT DISTINCT rid, item FROM m) GROUP BY rid)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(hit.c, 0)::BIGINT AS n_hit, coalesce(it.c, 0)::BIGINT AS n_items,
       sha256(coalesce(it.s, '')) AS items_sha256, coalesce(hit.c, 0) > 0 AS contaminated
FROM dw LEFT JOIN hit USING (rid) LEFT JOIN it USING (rid)
"""
