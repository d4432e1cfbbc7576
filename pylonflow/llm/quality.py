"""Quality rules as a short-circuit cascade.

Every rule rejects a text from a few of its statistics. A bounded sample is
run through every rule once to estimate its cost (seconds a document, shared
statistics not reused) and its selectivity (part of documents rejected);
rules are then ordered by rejection per cost, and each document meets them
in that order until the first one that rejects it. The order changes the
work, never the verdict: a document is kept when no rule rejects it.

Null texts are empty. Every input row gives one output row, repeated ids
included; other columns of the input are never looked at, so their names
cannot clash. Texts are read whole.
"""

from __future__ import annotations

import functools
import time
import unicodedata
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pylonflow.session import ship_package

SYMBOLS = b"#*$%&|<>"
WINDOW = 5


class Text:
    """Statistics of one text, each computed when first asked for."""

    def __init__(self, raw: bytes | None):
        self.raw = raw or b""
        self._got: dict[str, int] = {}

    def __getattr__(self, name: str):
        if name == "words":
            self.words = self.raw.split()   # bytes.split() splits on exactly \x20 and \x09-\x0D
            return self.words
        got = self.__dict__["_got"]
        if name not in got:
            got[name] = FEATURES[name](self)
        return got[name]


def _repeat_words(t: Text) -> int:
    """Words inside a 5-word window that occurs twice or more in the text (every occurrence counts)."""
    n = len(t.words)
    if n <= WINDOW:
        return 0
    ids: dict[bytes, int] = {}
    codes = np.fromiter((ids.setdefault(w, len(ids)) for w in t.words), np.int64, n)
    windows, base = codes[: n - WINDOW + 1], len(ids)
    span = base
    for k in range(1, WINDOW):   # an exact number for each window: re-ranked before it could overflow
        if span > (1 << 62) // base:
            distinct, windows = np.unique(windows, return_inverse=True)
            span = len(distinct)
        windows = windows * base + codes[k: n - WINDOW + 1 + k]
        span *= base
    order = np.argsort(windows, kind="stable")
    same = windows[order][1:] == windows[order][:-1]
    twice = np.zeros(len(windows), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    covered = np.zeros(n, bool)
    for k in range(WINDOW):
        covered[k: n - WINDOW + 1 + k] |= twice
    return int(covered.sum())


def _lines(t: Text) -> list[bytes]:
    return [x for x in t.raw.split(b"\n") if not x.isspace() and x]


def _dup_lines(t: Text) -> int:
    lines = _lines(t)
    return len(lines) - len(set(lines))


@functools.cache
def _class_of_code_point() -> np.ndarray:
    """2 for upper-case letters (Lu), 1 for other letters, else 0; built once in a worker."""
    return np.fromiter(((c == "Lu") + (c[0] == "L") for c in map(unicodedata.category, map(chr, range(0x110000)))),
                       np.uint8, 0x110000)


def _letter_counts(t: Text) -> np.ndarray:
    points = np.frombuffer(t.raw.decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
    return np.bincount(_class_of_code_point()[points], minlength=3)


FEATURES: dict[str, Callable[[Text], int]] = {
    "n_words": lambda t: len(t.words),
    "word_chars": lambda t: len(b"".join(t.words).decode("utf-8", "replace")),
    "n_symbols": lambda t: len(t.raw) - len(t.raw.translate(None, SYMBOLS)),
    "n_lines": lambda t: len(_lines(t)),
    "n_dup_lines": _dup_lines,
    "n_repeat_words": _repeat_words,
    "n_stutter": lambda t: sum(a == b for a, b in zip(t.words, t.words[1:], strict=False)),
    "letter_counts": _letter_counts,
    "n_upper": lambda t: int(t.letter_counts[2]),
    "n_letters": lambda t: int(t.letter_counts[1:].sum()),
}


@dataclass(frozen=True)
class Rule:
    """``rejects`` is true for a text to drop; ``base`` marks the rules of the contract."""

    name: str
    rejects: Callable[[Text], bool]
    base: bool = False


def default_rules() -> list[Rule]:
    """Two base rules and five for junk: symbol noise, shouting, tables, repeated lines, stuttered words."""
    return [
        Rule("too_short", lambda t: t.n_words < 10, base=True),
        Rule("repeated_windows", lambda t: 100 * t.n_repeat_words > 20 * t.n_words, base=True),
        Rule("symbols", lambda t: 10 * t.n_symbols > 2 * t.n_words),
        Rule("repeated_lines", lambda t: 2 * t.n_dup_lines > t.n_lines),
        Rule("stutter", lambda t: 10 * t.n_stutter > 3 * t.n_words),
        Rule("shouting", lambda t: 2 * t.n_upper > t.n_letters),
        Rule("word_length", lambda t: not 2 * t.n_words <= t.word_chars <= 30 * t.n_words),
    ]


def _binary(column) -> list[bytes | None]:
    return column.cast(pa.binary()).to_pylist()


def rule_costs(df: DataFrame, text: str, rules: list[Rule], sample_rows: int = 2000) -> list[dict]:
    """Seconds and rejected part of each rule, measured on about ``sample_rows`` documents.

    The sample is every document whose text hash falls below a threshold, so
    it does not depend on the partitioning; each task returns one row a rule.
    """
    ship_package(df.sparkSession)
    part = max(1, df.count() // sample_rows)
    sample = df.where(F.pmod(F.xxhash64(F.col(text)), F.lit(part)) == 0).select(F.col(text).alias("text"))

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, took, hit = 0, [0] * len(rules), [0] * len(rules)
        for batch in batches:
            raw = _binary(batch.column(0))
            n += len(raw)
            for k, rule in enumerate(rules):
                began = time.perf_counter_ns()
                hit[k] += sum(bool(rule.rejects(Text(x))) for x in raw)
                took[k] += time.perf_counter_ns() - began
        yield pa.RecordBatch.from_pydict({"k": pa.array(range(len(rules)), pa.int32()),
                                          "n": pa.array([n] * len(rules), pa.int64()),
                                          "ns": pa.array(took, pa.int64()), "hit": pa.array(hit, pa.int64())})

    got = {r["k"]: r for r in sample.mapInArrow(measure, "k int, n long, ns long, hit long").groupBy("k")
           .agg(F.sum("n").alias("n"), F.sum("ns").alias("ns"), F.sum("hit").alias("hit")).collect()}
    out = []
    for k, rule in enumerate(rules):
        n, ns, hit = (got[k]["n"], got[k]["ns"], got[k]["hit"]) if k in got else (0, 0, 0)
        out.append({"rule": rule.name, "rows": n, "cost": ns / 1e9 / max(n, 1), "rejects": hit / max(n, 1)})
    return out


def cascade_order(rules: list[Rule], costs: list[dict]) -> list[Rule]:
    """Rules by rejection per cost, best first; names break ties (an empty sample leaves them by name)."""
    by = {c["rule"]: c["rejects"] / max(c["cost"], 1e-9) for c in costs}
    return sorted(rules, key=lambda r: (-by.get(r.name, 0.0), r.name))


def run_cascade(df: DataFrame, text: str, rules: list[Rule], carry: list[str] = (),
                emit: tuple[str, ...] = ()) -> DataFrame:
    """One row per input row: the ``carry`` columns, ``kept``, ``base_failed``, ``rejected_by``
    (the first rule in this order that rejects, else null) and the statistics named in ``emit``.

    With no statistic to emit a rejected document pays only for the rules up
    to the one that rejects it; ``base_failed`` is then null where the
    cascade stopped earlier. With statistics asked for, the base rules are
    read off them and the rest of the cascade runs only where they pass.
    """
    ship_package(df.sparkSession)
    base, rest = [r for r in rules if r.base], [r for r in rules if not r.base]
    keep = [F.col(c) for c in carry]
    source = df.select(*keep, F.col(text).alias("_cascade_text"))

    def judge(raw: bytes | None) -> tuple:
        t = Text(raw)
        if emit:
            values = tuple(getattr(t, f) for f in emit)
            failed = next((r.name for r in base if r.rejects(t)), None)
            first = failed or next((r.name for r in rest if r.rejects(t)), None)
            return values + (failed is not None, first)
        first = next((r for r in rules if r.rejects(t)), None)
        return (None if first and not first.base else first is not None, first.name if first else None)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [judge(x) for x in _binary(batch.column(batch.num_columns - 1))]
            if not rows:
                continue
            cols = list(zip(*rows, strict=True))
            arrays = [batch.column(k) for k in range(len(carry))]
            arrays += [pa.array(c, pa.int64()) for c in cols[: len(emit)]]
            arrays += [pa.array(cols[-2], pa.bool_()), pa.array(cols[-1], pa.string())]
            arrays.append(pa.array([x is None for x in cols[-1]], pa.bool_()))
            yield pa.RecordBatch.from_arrays(arrays, names=out_names)

    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema.fields[:-1]]
                       + [f"{f} long" for f in emit]
                       + ["base_failed boolean", "rejected_by string", "kept boolean"])
    out_names = [*carry, *emit, "base_failed", "rejected_by", "kept"]
    return source.mapInArrow(apply, schema)


def quality_cascade(df: DataFrame, text: str = "text", carry: list[str] = (), emit: tuple[str, ...] = (),
                    rules: list[Rule] | None = None, sample_rows: int = 2000) -> DataFrame:
    """Measure, order, run (see the module's description)."""
    rules = rules or default_rules()
    return run_cascade(df, text, cascade_order(rules, rule_costs(df, text, rules, sample_rows)), carry, emit)


def op3_quality_rules(spark, sf_dir: str) -> DataFrame:
    from pylonflow.llm.common import documents
    got = quality_cascade(documents(spark, sf_dir), "text", ["doc_id"],
                          ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"))
    return got.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                      "base_failed", "kept")


# Default rules' thresholds as SQL; windows are numbered rows, lines are split on \n only.
OP3_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
s AS (SELECT rid, doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w,
             list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ln FROM d),
wd AS (SELECT rid, unnest(w) AS word, unnest(range(len(w))) AS i FROM s),
win AS (SELECT rid, i, [word, lead(word, 1) OVER o, lead(word, 2) OVER o, lead(word, 3) OVER o,
               lead(word, 4) OVER o] AS g, lead(word, 4) OVER o IS NOT NULL AS whole
        FROM wd WINDOW o AS (PARTITION BY rid ORDER BY i)),
rep AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS c FROM win WHERE whole) WHERE c > 1),
cov AS (SELECT rid, count(DISTINCT i + k) AS n FROM rep, (SELECT unnest(range(5)) AS k) GROUP BY rid),
stut AS (SELECT rid, count(*) AS n FROM win WHERE g[1] = g[2] GROUP BY rid),
f AS (SELECT s.rid, doc_id, len(w)::BIGINT AS n_words,
             coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
             (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
             (len(ln) - len(list_distinct(ln)))::BIGINT AS n_dup_lines,
             coalesce(cov.n, 0)::BIGINT AS n_repeat_words, len(ln) AS n_lines, coalesce(stut.n, 0) AS n_stutter,
             length(regexp_replace(text, '[^\p{Lu}]', '', 'g')) AS n_upper,
             length(regexp_replace(text, '[^\p{L}]', '', 'g')) AS n_letters
      FROM s LEFT JOIN cov USING (rid) LEFT JOIN stut USING (rid)),
b AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM f)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT 10 * n_symbols > 2 * n_words AND NOT 2 * n_dup_lines > n_lines
       AND NOT 10 * n_stutter > 3 * n_words AND NOT 2 * n_upper > n_letters
       AND word_chars BETWEEN 2 * n_words AND 30 * n_words AS kept
FROM b
"""
