"""Source divergence against a plain count in Python, and its SQL."""

import random
import re
from collections import Counter, defaultdict

import duckdb
import pytest

from pylonflow.llm import divergence
from tests.conftest import SF001

TERM = re.compile("[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
FIXED = "lang string, source string, text string, term string, total long, `group` long"


def brute(rows, min_docs=10, top=10):
    counts, docs, langs = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for lang, source, text in [tuple(x or "" for x in r) for r in rows]:
        words = [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in TERM.findall(text)]
        counts[lang, source].update(words)
        docs[lang].update(set(words))
        langs[lang].add(source)
    out = set()
    for lang, sources in langs.items():
        kept = sorted(t for t, n in docs[lang].items() if n >= min_docs)
        whole = Counter()
        for s in sources:
            whole.update(counts[lang, s])

        def rates(c):
            total = sum(c[t] for t in kept) + 2 * len(kept)
            return {t: 1 + 10**9 * (c[t] + 2) // total for t in kept}

        q, ps = rates(whole), {s: rates(counts[lang, s]) for s in sources}
        for s in sources:
            pairs = [(o, sum((ps[s][t] - ps[o][t]) ** 2 // (ps[s][t] + ps[o][t]) for t in kept)) for o in sources - {s}]
            terms = [(t, (ps[s][t] - q[t]) ** 2 // (ps[s][t] + q[t])) for t in kept if counts[lang, s][t] and ps[s][t] > q[t]]
            for part, items in (("pair", pairs), ("term", terms)):
                order = sorted(items, key=lambda x: (-x[1], x[0].encode()))
                out |= {(lang, s, part, t, v, k) for k, (t, v) in enumerate(order, 1) if part == "pair" or k <= top}
    return out


def got(df, **options):
    rows = [tuple(r) for r in divergence.source_divergence(df, **options).collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def corpus(seed, n):
    rnd = random.Random(seed)
    words = ["the", "The", "of", "über", "ÜBER", "漢字", "a1b", "x-y", "rare", "é", "common", "K", "ſ"] + [f"w{chr(97 + k)}" for k in range(26)]
    for k in range(n):
        lang = rnd.choice(["en", "en", "en", None, "", "de", "x y"])
        source = None if k % 17 == 0 else f"s{min(rnd.randint(0, 9), 5)}"
        text = None if k % 23 == 0 else "" if k % 29 == 0 else " ".join(rnd.choice(words[:5 + (k % 5) * 8]) for _ in range(rnd.randint(1, 40)))
        yield lang, source, text


@pytest.mark.parametrize("block,chunk,pairs", [(divergence.BLOCK, divergence.CHUNK, divergence.PAIRS), (30, 4, 7)])
def test_equals_plain_counting(spark, monkeypatch, block, chunk, pairs):
    monkeypatch.setattr(divergence, "CHUNK", chunk)
    monkeypatch.setattr(divergence, "PAIRS", pairs)
    rows = [*corpus(1, 400), ("zz", "only", "few words"), ("zz", "other", None), ("one", "one", "the " * 30)]
    frame = spark.createDataFrame([(*r, "clash", 1, 2) for r in rows * 2], FIXED).repartition(7)
    for min_docs in (10, 60):
        assert got(frame, block=block, min_docs=min_docs) == brute(rows * 2, min_docs)


def test_hot_group_long_text_and_repeated_rows(spark, monkeypatch):
    monkeypatch.setattr(divergence, "WINDOW", 200)
    rows = [("en", "hot", "alpha beta gamma")] * 3000 + [("en", f"s{k % 40}", f"alpha word{chr(97 + k % 26)} beta") for k in range(600)]
    rows += [("en", "long", " ".join(f"alpha beta{chr(97 + k % 26)}" for k in range(20_000)))] * 2
    assert got(spark.createDataFrame(rows, "lang string, source string, text string"), block=500) == brute(rows)


def test_large_counts_stay_exact(spark):
    groups = [("en", "a", 9 * 10**12, 5 * 10**14 + 7), ("en", "b", 3, 12)]
    frame = spark.createDataFrame(groups, "lang string, source string, n long, total long")
    found = frame.select(divergence._rate("n", "total").alias("p")).collect()
    assert [r["p"] for r in found] == [1 + 10**9 * (n + 2) // total for _, _, n, total in groups]


def test_empty_table_and_odd_rows(spark, odd_docs, no_docs):
    assert got(no_docs) == set()
    rows = [(r["lang"], r["source"], r["text"]) for r in odd_docs.collect()]
    for min_docs in (1, 2, 10):
        assert got(odd_docs, min_docs=min_docs) == brute(rows, min_docs)


def test_query_equals_its_sql(spark):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF001}/documents.parquet')")
    want = set(con.sql(divergence.OP13_SQL).fetchall())
    rows = [tuple(r) for r in divergence.op13_source_divergence(spark, SF001).collect()]
    assert len(rows) == len(want) > 1000
    assert set(rows) == want
