"""Piece encoding against the library whose vocabulary it reads."""

import hashlib
import random

import numpy as np
import pytest
import sentencepiece
from pyspark.sql import functions as F

from pylonflow.llm import pieces
from tests.conftest import SF001

MODEL = pieces.default_model()


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


@pytest.fixture(scope="module")
def vocabulary():
    return pieces.read_vocabulary(MODEL)


def texts(seed, n):
    rnd = random.Random(seed)
    words = list(pieces.read_vocabulary(MODEL).ids)
    sets = ["abcdefgh ", " ", "ab bca  ", "01 2.\n\t", "éüßаб漢字ゼ🎉‍\x00 ", "▁ a", "the re in on "]
    for k in range(n):
        if k % 3 == 2:
            yield "".join(rnd.choice(words).replace("▁", rnd.choice(" ▁")) for _ in range(rnd.randint(1, 9)))
        else:
            yield "".join(rnd.choice(sets[k % len(sets)]) for _ in range(rnd.randint(0, 60)))


def test_ids_and_texts_equal_the_library(vocabulary, library):
    encoder, decoder = pieces.Encoder(vocabulary), pieces.Decoder(vocabulary)
    all_texts = [*texts(3, 6000), "-".join(["a"] * 3000), " " * 500, "x" * 2000, "▁" * 33 + "the"]
    ids, counts = encoder.encode_all(all_texts)
    offsets = np.concatenate([[0], np.cumsum(counts)])
    want = library.encode(all_texts)
    assert [ids[a:b].tolist() for a, b in zip(offsets[:-1], offsets[1:], strict=True)] == want
    assert decoder.decode(offsets, ids).to_pylist() == library.decode(want)


def test_windows_and_forgotten_words_change_nothing(vocabulary, library, monkeypatch):
    monkeypatch.setattr(pieces, "WINDOW", 40)
    monkeypatch.setattr(pieces, "KEPT_WORDS", 3)
    monkeypatch.setattr(pieces, "KEPT_PAIRS", 5)
    monkeypatch.setattr(pieces, "SHORT", 6)
    encoder, all_texts = pieces.Encoder(vocabulary), [" ".join(texts(seed, 20)) for seed in range(40)]
    ids, counts = encoder.encode_all(all_texts)
    assert np.split(ids, np.cumsum(counts)[:-1])[7].tolist() == library.encode(all_texts)[7]
    assert ids.tolist() == [k for x in library.encode(all_texts) for k in x]


def test_pair_test_equals_merging(vocabulary):
    rnd, plain = random.Random(5), sorted(vocabulary.plain)
    ids, seen = vocabulary.ids, set()
    for k in range(6000):
        a, b = rnd.choice(plain), rnd.choice(plain)
        p = vocabulary.pieces[rnd.choice(plain)]
        if k % 2 and len(p) > 1:
            cut = rnd.randint(1, len(p) - 1)
            a, b = ids.get(p[:cut], a), ids.get(p[cut:], b)
        ok = vocabulary.merged(vocabulary.pieces[a] + vocabulary.pieces[b]) == [a, b]
        assert vocabulary.fits(a, b) == ok
        seen.add(ok)
    assert seen == {True, False}


def test_a_vocabulary_with_equal_scores_and_pieces_scored_before_their_parts(vocabulary):
    # 'bc' before 'abc' is made of 'ab' + 'c'; 'xx', 'xxx' and 'xxxx' share a score
    words = ["▁", "a", "b", "c", "x", "ab", "bc", "abc", "xx", "xxx", "xxxx", "▁a"]
    scores = [0, 0, 0, 0, 0, -2, -3, -1, -5, -5, -5, -4]
    v = pieces.Vocabulary(words, scores, [pieces.NORMAL] * len(words), True)
    encoder, rnd = pieces.Encoder(v), random.Random(2)
    for _ in range(3000):
        text = "".join(rnd.choice("abcx ") for _ in range(rnd.randint(1, 14)))
        ids, _ = encoder.encode_all([text])
        assert ids.tolist() == v.merged("▁" + text.replace(" ", "▁")), text


def test_decoding_ids_that_no_text_has(vocabulary, library):
    decoder, rnd = pieces.Decoder(vocabulary), random.Random(4)
    lists = [[rnd.choice([rnd.randint(0, 31999), rnd.randint(3, 258), rnd.randint(131, 258), 259, 28705, 0, 1, 2])
              for _ in range(rnd.randint(0, 9))] for _ in range(3000)]
    for x in lists:
        assert decoder.decode(np.array([0, len(x)]), np.array(x, np.int32)).to_pylist() == [library.decode(x)], x
    with pytest.raises(ValueError):
        decoder.decode(np.array([0, 1]), np.array([32000]))


def test_rows(spark, odd_docs, no_docs, library):
    got = pieces.encode(odd_docs.withColumn("ids", F.lit("clash")), out="tokens")
    assert got.columns == [c for c in odd_docs.columns if c != "text"] + ["ids", "tokens"]
    rows = sorted((r["doc_id"] or 0, r["tokens"]) for r in got.collect())
    assert rows == sorted((r["doc_id"] or 0, library.encode(r["text"] or "")) for r in odd_docs.collect())
    back = pieces.decode(got.select("doc_id", "tokens"), "tokens", "text").collect()
    assert sorted((r["doc_id"] or 0, r["text"]) for r in back) == sorted((r["doc_id"] or 0, r["text"] or "") for r in odd_docs.collect())
    assert pieces.encode(no_docs).count() == 0
    nothing = spark.createDataFrame([(1, None), (2, [])], "k int, ids array<int>")
    assert [r["text"] for r in pieces.decode(nothing).orderBy("k").collect()] == ["", ""]


def test_query_equals_the_library(spark, library):
    def sha(s):
        return hashlib.sha256(s.encode()).hexdigest()
    got = {r["doc_id"]: (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in pieces.op11_piece_encoding(spark, SF001).collect()}
    docs = spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(docs)
    for r in docs:
        ids = library.encode(r["text"] or "")
        assert got[r["doc_id"]] == (len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids)))
