"""Personal data by bootstrapped contextual extraction.

Seeds are the entities that fixed expressions find: e-mail addresses, IP
addresses, card numbers and phone numbers. The one to three words in front
of an entity are its lexical patterns. Candidates are other tokens, or series of
digit groups with single separators, that look like one of the kinds without
being well formed (a card number with a wrong check digit, a phone number
without country code).

Patterns and instances form a graph that Spark scores in rounds: a pattern's
confidence for a kind is the confidence of the known instances it introduces
over its decided occurrences in the corpus, counted exactly: those before
known instances and those before anything that is no candidate of the kind.
Candidates not yet known speak neither for nor against it. An instance's
confidence is that of its best pattern. Only patterns with several distinct
known instances count. Instances at or above ``accept`` are discovered: all
their occurrences become spans, and the patterns they stand in are scored
with them in the next round, until a round finds nothing new. Base spans
always stay; a discovered span inside another one of its kind is left out.

Two scans of the texts (entities, then pattern counts); what is joined are
distinct (pattern, instance) pairs. A fixed-size bit field tells the second
scan which patterns to count; hits by chance drop out in the join.

Null and empty texts have no spans; every input row gives one output row,
repeated ids included; only the named columns are read. Offsets are code
points, ends exclusive.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pylonflow.llm.common import documents, stored
from pylonflow.llm.decontaminate import _slices, words_of
from pylonflow.llm.jaccard import _LOWER
from pylonflow.session import ship_package

KINDS = ("email", "ip", "card", "phone")
WORDS = 3                # longest pattern
FIELD_BITS = 23          # bits of the pattern field: 1 MB whatever the corpus holds
MASK, MULT = (1 << 64) - 1, 0x9E3779B97F4A7C15

# The expressions of the contract; quantifiers do not give back what no later part could use, so time is linear.
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_CANDIDATE = re.compile(r"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D]*[0-9@][^\x20\x09-\x0D]*")
_RUN = re.compile(r"[0-9]++(?:\)?(?:\x20?[-/]\x20?|[.\x20])?\(?[0-9]++)*+")
_DIGITS = re.compile(r"[0-9]++")
_EDGE = "\"'`.,;:!?()[]{}<>|*#$%&="
_SPACE = re.compile(r"[\x20\x09-\x0D]+")


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if k % 2 == 0 else (2 * d if d < 5 else 2 * d - 9)
    return total % 10 == 0


def _emails(t: str) -> list[tuple[int, int]]:
    out, end, at = [], 0, t.find("@")
    while at >= 0:
        start = at
        while start > end and t[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(t, at + 1) if start < at else None
        if m:
            out.append((start, m.end()))
            end = m.end()
        at = t.find("@", max(end, at + 1))
    return out


def base_spans(t: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the contract's entities, in order of start, then kind."""
    out = [(a, 0, b) for a, b in _emails(t)]
    for m in _IP.finditer(t):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            out.append((m.start(), 1, m.end()))
    for m in _CARD.finditer(t):
        digits = m[0].replace(" ", "").replace("-", "")
        if 12 <= len(digits) <= 19 and luhn(digits):
            out.append((m.start(), 2, m.end()))
    for m in _PHONE.finditer(t):
        if 9 <= sum("0" <= c <= "9" for c in m[0]) <= 15:
            out.append((m.start(), 3, m.end()))
    return sorted(out)


def _shape(token: str) -> int | None:
    """The kind a malformed token looks like."""
    digits = sum("0" <= c <= "9" for c in token)
    if "@" in token:
        return 0 if token[0] != "@" and token[-1] != "@" else None
    if not digits or any(c not in "0123456789.-/" for c in token):
        return None
    if token.count(".") == 3 and all(token.split(".")):
        return 1
    return 2 if 12 <= digits <= 19 else 3 if 7 <= digits <= 11 else None


# Of a series of digit groups: least and most digits, and the fewest in a group after the first.
_SERIES = {2: (12, 19, 3), 3: (7, 11, 2)}


def _series(t: str, shaped: dict[int, int], taken: list[tuple[int, int]]) -> Iterator[tuple[int, int, int]]:
    """(start, kind, end) of digit groups that read as a number of the kind: from each group that begins a word, the
    longest series of whole groups. Tokens in ``shaped`` (start: kind) have their kind without what follows."""
    k = 0
    for run in _RUN.finditer(t):
        groups = [g.span() for g in _DIGITS.finditer(t, run.start(), run.end())]
        if len(groups) < 2:
            continue
        while k < len(taken) and taken[k][1] <= groups[0][0]:
            k += 1
        near = k
        for i, (a, b) in enumerate(groups):
            while near < len(taken) and taken[near][1] <= a:
                near += 1
            open_ = a > 0 and t[a - 1] == "("
            before = t[a - 1 - open_: a - open_]
            own = shaped.get(a, shaped.get(a - 1) if open_ else None)
            if own == 1 or (before and not before.isspace() and before not in _EDGE) or before in (".", ")"):
                continue
            for kind, (least, most, part) in _SERIES.items():
                if own == kind:
                    continue
                digits, end = 0, None
                for j, (x, y) in enumerate(groups[i:]):
                    digits += y - x
                    if digits > most or (j and y - x < part) or any(u < y and v > a for u, v in taken[near: near + 8]):
                        break
                    if j and digits >= least and not (t[y: y + 1].isalnum() or t[y: y + 1] in ("_", "@")):
                        end = y
                if end is not None:
                    yield a - (open_ and ")" in t[a:end]), kind, end


def candidates(t: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """(start, kind, end) of whole tokens, edges trimmed, and of series of digit groups that look like a kind and
    overlap no base span; of a kind at most one at a start."""
    out, k = [], 0
    taken = sorted((a, b) for a, _, b in base)
    for m in _CANDIDATE.finditer(t):
        token = m[0].strip(_EDGE)
        if not token:
            continue
        start = m.start() + m[0].index(token)
        end = start + len(token)
        while k < len(taken) and taken[k][1] <= start:
            k += 1
        if any(a < end and b > start for a, b in taken[k: k + 8]):
            continue
        kind = _shape(token)
        if kind is not None:
            out.append((start, kind, end))
    out.extend(_series(t, {a: kind for a, kind, _ in out}, taken))
    return sorted(set(out))


def _word_hash(word: bytes) -> int:
    return xxhash.xxh64_intdigest(word)


def pattern_hashes(t: str, start: int) -> list[int]:
    """Signed 64-bit hashes of the one, two and three words before ``start``, nearest first."""
    low = start
    words: list[str] = []
    while low > 0 and len(words) <= WORDS:   # widen until the words wanted are whole
        low = max(0, low - 200)
        words = _SPACE.split(t[low:start])
        if low == 0 and words and words[0] == "":
            words = words[1:]
    if not words or words[-1].strip(_EDGE):   # the entity stands inside a token
        return []
    words = [w.translate(_ASCII_LOWER) for w in words[:-1] if w]
    out, acc = [], 0
    for k, w in enumerate(reversed(words[-WORDS:])):
        acc = (acc * MULT + _word_hash(w.encode()) + k + 1) & MASK
        out.append(acc - (1 << 64) if acc >> 63 else acc)
    return out


_ASCII_LOWER = {c: c + 32 for c in range(65, 91)}


def _found(df: DataFrame, key: str, text: str) -> DataFrame:
    """Stored, one row a document: rid, id, base spans, and entities with their patterns."""
    kind_of_id = df.schema[key].dataType.simpleString()
    entity = pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32()), ("seed", pa.bool_()),
                        ("value", pa.string()), ("patterns", pa.list_(pa.int64()))])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rid = TaskContext.get().partitionId() << 40
        for b in batches:
            for lo, hi in _slices(b.column(1), 4 << 20):
                rows = []
                for t in b.column(1).slice(lo, hi - lo).to_pylist():
                    t = t or ""
                    base = base_spans(t)
                    rows.append([{"kind": k, "start": a, "end": e, "seed": seed, "value": t[a:e].lower(),
                                  "patterns": pattern_hashes(t, a)}
                                 for seed, found in ((True, base), (False, candidates(t, base))) for a, k, e in found])
                n = len(rows)
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(rid, rid + n)), b.column(0).slice(lo, hi - lo),
                                                  pa.array(rows, pa.list_(entity))], names=["rid", "id", "found"])
                rid += n

    return stored(df.select(F.col(key).alias("id"), F.col(text).cast("string").alias("text")).mapInArrow(
        scan, f"rid long, id {kind_of_id}, found array<struct<kind:int,start:int,end:int,seed:boolean,value:string,"
              "patterns:array<bigint>>>"), "entities")


def _pattern_counts(df: DataFrame, text: str, patterns: DataFrame) -> DataFrame:
    """(pattern, total): occurrences of the given patterns in all texts, that is the words they stand before."""
    bit = F.pmod("pattern", F.lit(1 << FIELD_BITS))
    bits = (patterns.select(bit.alias("bit")).groupBy(F.shiftright("bit", 6).cast("int").alias("word"))
            .agg(F.bit_or(F.expr("shiftleft(1L, CAST(bit % 64 AS INT))")).alias("bits")).collect())
    field = np.zeros(1 << (FIELD_BITS - 6), np.int64)
    for r in bits:
        field[r["word"]] = r["bits"]
    sent = df.sparkSession.sparkContext.broadcast(field)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo, hi in _slices(b.column(0), 4 << 20):
                words, counts = words_of(b.column(0).slice(lo, hi - lo), _LOWER)
                if not len(words):
                    continue
                coded = words.dictionary_encode()
                table = np.fromiter(map(_word_hash, coded.dictionary.to_pylist()), np.uint64, len(coded.dictionary))
                h = table[coded.indices.to_numpy()]
                place = np.arange(len(h)) - np.repeat(np.cumsum(counts) - counts, counts)   # a word's number in its text
                last = np.repeat(counts, counts) - 1
                acc, hits = np.zeros(len(h), np.uint64), []
                for k in range(WORDS):   # patterns that end with each word, words taken backwards
                    acc = acc * np.uint64(MULT) + np.concatenate([np.zeros(k, np.uint64), h[: len(h) - k]]) + np.uint64(k + 1)
                    at = acc & np.uint64((1 << FIELD_BITS) - 1)
                    known = (sent.value[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63)).astype(np.int64)) & 1 == 1
                    hits.append(acc[known & (place >= k) & (place < last)])
                values, n = np.unique(np.concatenate(hits), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(values.view(np.int64)), pa.array(n.astype(np.int64))], names=["pattern", "n"])

    got = df.select(F.col(text).cast("string").alias("text")).mapInArrow(count, "pattern long, n long")
    return stored(got.groupBy("pattern").agg(F.sum("n").alias("total")).join(patterns, "pattern", "left_semi"), "patterns")


def discover(found: DataFrame, totals_of, rounds: int | None = None, support: int = 3, sure: float = 0.5,
             accept: float = 0.8) -> DataFrame:
    """(value, kind) of discovered instances.

    ``totals_of`` maps a table of patterns to (pattern, total). ``support``
    is the number of distinct known instances a pattern needs, ``sure`` the
    least confidence of a pattern, ``accept`` that of an instance. Rounds go
    on until one finds nothing new, or ``rounds`` of them have run.
    """
    entity = found.select(F.explode("found").alias("e")).select("e.kind", "e.seed", "e.value", "e.patterns")
    edges = stored(entity.select("kind", "seed", "value", F.explode("patterns").alias("pattern"))
                   .groupBy("pattern", "value", "kind").agg(F.max("seed").alias("seed"), F.count("*").alias("n")), "edges")
    wide = edges.groupBy("pattern").agg(F.count("*").alias("c")).where(F.col("c") >= support).select("pattern")
    totals = totals_of(stored(wide, "wide"))
    # other: occurrences before what is no entity and no candidate of the kind
    other = (edges.groupBy("pattern", "kind").agg(F.sum("n").alias("own")).join(totals, "pattern")
             .select("pattern", "kind", F.greatest(F.col("total") - F.col("own"), F.lit(0)).alias("other")))
    edges = stored(edges.join(other, ["pattern", "kind"]), "edges")
    seeds = edges.where("seed").select("value", "kind").distinct()
    new = edges.select("value", "kind", F.lit(1.0).alias("conf")).limit(0)
    while rounds is None or rounds > 0:
        known = seeds.withColumn("conf", F.lit(1.0)).unionByName(new)
        scored = (edges.join(known, ["value", "kind"]).groupBy("pattern", "kind")
                  .agg(F.sum(F.col("n") * F.col("conf")).alias("hits"), F.sum("n").alias("n"), F.count("*").alias("c"),
                       F.max("other").alias("other"))
                  .where(F.col("c") >= support).select("pattern", "kind", (F.col("hits") / (F.col("n") + F.col("other"))).alias("conf")))
        scored = scored.where(F.col("conf") >= sure)
        fresh = (edges.where("NOT seed").join(scored, ["pattern", "kind"]).groupBy("value", "kind")
                 .agg(F.max("conf").alias("conf")).where(F.col("conf") >= accept))
        fresh = stored(fresh.join(known.select("value", "kind"), ["value", "kind"], "left_anti"), "instances")
        if fresh.isEmpty():
            break
        new = new.unionByName(fresh)   # what is known stays known, so the rounds come to an end
        rounds = None if rounds is None else rounds - 1
    return new.select("value", "kind")


def find_pii(df: DataFrame, key: str = "doc_id", text: str = "text", **settings) -> DataFrame:
    """(id, base, added) of every row: arrays of (start, kind, end), kinds numbered as in ``KINDS``, sorted."""
    ship_package(df.sparkSession)
    found = _found(df, key, text)
    new = discover(found, lambda patterns: _pattern_counts(df, text, patterns), **settings)
    span = lambda e: F.struct(e["start"].alias("start"), e["kind"].alias("kind"), e["end"].alias("end"))
    base = F.array_sort(F.transform(F.filter("found", lambda e: e["seed"]), span))
    loose = found.select("rid", F.explode(F.filter("found", lambda e: ~e["seed"])).alias("e")).select("rid", "e.*")
    loose = loose.join(new, ["value", "kind"])
    earlier = Window.partitionBy("rid", "kind").orderBy("start", F.desc("end")).rowsBetween(Window.unboundedPreceding, -1)
    added = (loose.withColumn("_reach", F.max("end").over(earlier)).where("_reach IS NULL OR _reach < end").groupBy("rid")
             .agg(F.array_sort(F.collect_list(F.struct("start", "kind", "end"))).alias("added")))
    return found.select("rid", "id", base.alias("base")).join(added, "rid", "left").select(
        "id", "base", F.coalesce("added", F.expr("CAST(array() AS array<struct<start:int,kind:int,end:int>>)")).alias("added"))


def op5_pii(spark, sf_dir: str) -> DataFrame:
    got = find_pii(documents(spark, sf_dir))
    names = F.array(*[F.lit(k) for k in KINDS])
    said = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", names[s["kind"]], s["start"].cast("string"), s["end"].cast("string"))), ",")
    of_kind = lambda k: lambda s: s["kind"] == k  # noqa: E731  a second parameter would be the span's index
    counts = [F.size(F.filter("base", of_kind(k))).cast("long").alias(f"n_{name}") for k, name in enumerate(KINDS)]
    return got.select(F.col("id").alias("doc_id"), *counts, F.sha2(said(F.col("base")), 256).alias("base_sha256"),
                      said(F.array_sort(F.concat("base", "added"))).alias("spans"))
