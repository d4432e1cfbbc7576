import hashlib
import re

import numpy as np
import pyarrow as pa
import pytest

from pylonflow.llm import decontaminate as d
from tests.llm.conftest import sentence

ASCII = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(ASCII))


def brute(text, items, window=10):
    w, hit, owners = words(text), set(), set()
    for item, t in items:
        b = words(t)
        for i in range(max(len(b) - window, 0) + 1 if b else 0):
            g = b[i:i + window]
            for k in range(len(w) - len(g) + 1):
                if w[k:k + len(g)] == g:
                    hit |= set(range(k, k + len(g)))
                    owners.add("" if item is None else str(item))
    return len(w), len(hit), sorted(owners)


ITEMS = [(3, sentence(1, 14)), (20, sentence(2, 3)), (5, sentence(2, 3).upper()), (7, None), (8, ""), (None, sentence(3, 25)), (3, "unseen words here")]


@pytest.mark.parametrize("block", [50_000, 4])
def test_contamination_matches_brute_force(spark, odd_docs, block):
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    got = d.search(d.build_index(odd_docs, segment_bytes=300), d.phrases_of(bench), block_phrases=block).collect()
    want = sorted((str(r["doc_id"]), *brute(r["text"], ITEMS)) for r in odd_docs.collect())
    assert sorted((str(r["key"]), r["n_words"], r["n_hit"], sorted(r["items"])) for r in got) == want
    assert any(w[2] for w in want)
    for r in got:
        assert len(r["positions"]) == r["n_hit"]


def test_empty_tables(spark, odd_docs, no_docs):
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    none = spark.createDataFrame([], "item_id long, text string")
    assert d.contamination(no_docs, bench).count() == 0
    got = d.contamination(odd_docs, none).collect()
    assert len(got) == odd_docs.count() and all(r["n_hit"] == 0 and r["items"] == [] for r in got)
    assert d.digest([]) == hashlib.sha256(b"").hexdigest()


def test_words_of_splits_at_text_boundaries():
    got, counts = d.words_of(pa.array(["ab", None, "", "cd-ef", "É9 !", "x"]))
    assert got.to_pylist() == [b"ab", b"cd", b"ef", "É9".encode(), b"x"] and counts.tolist() == [1, 0, 0, 2, 1, 1]
    assert d.words_of(pa.array([], pa.string()))[1].tolist() == []


def test_proximity_finds_terms_within_a_span(spark):
    docs = spark.createDataFrame([(1, "red big green small blue"), (2, "red one two three four five blue green"), (3, "blue green red"), (4, "red"), (5, "green blue")], "doc_id long, text string")
    phrases = spark.createDataFrame([(["red", "green", "blue"], "p")], "phrase array<string>, item string")
    index = d.build_index(docs)
    got = {r["key"]: r["positions"] for r in d.search(index, phrases, proximity=5).collect()}
    assert got == {"1": [0, 1, 2, 3, 4], "2": [], "3": [0, 1, 2], "4": [], "5": []}
    assert {r["key"] for r in d.search(index, phrases, proximity=8).collect() if r["n_hit"]} == {"1", "2", "3"}
    assert not any(r["n_hit"] for r in d.search(index, phrases).collect())


def test_slices_cover_all_rows_once():
    texts = pa.array(["x" * k for k in (0, 5, 50, 1, 1, 1, 100, 0)] + [None])
    cuts = list(d._slices(texts, 10))
    assert cuts[0][0] == 0 and cuts[-1][1] == 9 and all(a[1] == b[0] for a, b in zip(cuts, cuts[1:], strict=False))
    assert list(d._slices(pa.array([], pa.string()), 10)) == []


def test_index_lists_decode_to_positions():
    lists = d._Lists([b"a"], [np.array([3, 2, 5], np.int32).tobytes()])
    assert lists[b"a"].tolist() == [3, 5, 10]
