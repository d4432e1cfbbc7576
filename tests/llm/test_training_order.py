import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from pylonflow.llm import training_order as t


@pytest.mark.parametrize("n", [1, 2, 3, 5, 16, 17, 1000, 65_537])
def test_permutation_is_a_bijection_with_an_inverse(n):
    p = t.permute(np.arange(n), n)
    assert np.array_equal(np.sort(p), np.arange(n)) and np.array_equal(t.permute(p, n, inverse=True), np.arange(n))
    if n > 100:
        assert not np.array_equal(p, t.permute(np.arange(n), n, key=2)) and abs(np.corrcoef(np.arange(n), p)[0, 1]) < 0.2


def test_stream_round_trips_through_shards(spark, odd_docs, tmp_path):
    tokens = t.tokenise(odd_docs)
    rows = sorted(tokens.collect(), key=lambda r: (r["part"], r["at"]))
    assert len(rows) == odd_docs.count()
    texts = sorted(str((r["doc_id"], r["text"] or "")) for r in odd_docs.collect())
    path, pattern = t.default_ranks()
    enc = t._encoder(open(path, "rb").read(), pattern)
    said = [(int(r["key"]) if r["key"] else None, enc.decode(np.frombuffer(r["tokens"], np.uint16)[:-1].tolist())) for r in rows]
    assert sorted(map(str, said)) == texts and all(np.frombuffer(r["tokens"], np.uint16)[-1] == t.END_OF_TEXT for r in rows)

    stream = b"".join(r["tokens"] for r in rows)
    sequences = t.training_order(tokens, length=64, rows=50)
    got = sequences.collect()
    n = -(-len(stream) // 128)
    assert sorted(r["slot"] for r in got) == list(range(n))
    assert [r["slot"] for r in sorted(got, key=lambda r: r["sequence"])] == t.permute(np.arange(n), n).tolist()
    assert b"".join(r["tokens"] for r in sorted(got, key=lambda r: r["sequence"]))[: len(stream)] == stream

    uri = f"file://{tmp_path}/shards"
    manifest = sorted(t.write_shards(sequences, uri, rows=50).collect())
    assert sum(m["rows"] for m in manifest) == n and [m["first_slot"] for m in manifest] == list(range(0, n, 50))
    assert sorted(os.listdir(tmp_path / "shards")) == [m["file"] for m in manifest]
    for r in got[:: max(1, len(got) // 40)]:   # a slot is read by its place alone
        with open(tmp_path / "shards" / f"shard-{r['slot'] // 50:06d}.bin", "rb") as f:
            f.seek(r["byte_offset"])
            assert f.read(128) == r["tokens"]


def test_empty_table(spark, no_docs):
    assert t.training_order(t.tokenise(no_docs)).count() == 0


def test_shards_without_a_second_shuffle_and_reads_from_a_slot_on(spark, odd_docs, tmp_path):
    sequences = t.training_order(t.tokenise(odd_docs), length=64, rows=50)
    one, two = (f"file://{tmp_path}/{name}" for name in ("one", "two"))
    manifest = t.write_shards(sequences, one, rows=50, dealt=True)
    assert sorted(manifest.collect()) == sorted(t.write_shards(sequences, two, rows=50).collect())
    want = [(r["slot"], bytes(r["tokens"])) for r in sorted(sequences.collect(), key=lambda r: r["slot"])]
    assert len(want) > 120
    for first in (0, 73, len(want), len(want) + 9):   # inside a shard; past the end
        assert [(r["slot"], bytes(r["tokens"])) for r in t.read_shards(manifest, one, first, 64, 50).collect()] == want[first:]


def test_query_writes_its_shards(spark, odd_docs, tmp_path, monkeypatch):
    odd_docs.write.parquet(f"{tmp_path}/documents.parquet")
    monkeypatch.setattr(t, "scratch_path", lambda spark, *parts: f"{tmp_path}/{parts[-1]}")
    got = sorted(t.op9_training_order(spark, str(tmp_path)).collect())
    stream = t.training_order(t.tokenise(spark.read.parquet(f"{tmp_path}/documents.parquet")))
    assert got == sorted(stream.collect()) and got[0]["slot"] == 0
    with open(tmp_path / "shards" / "shard-000000.bin", "rb") as f:
        assert f.read() == b"".join(r["tokens"] for r in got)


def test_shards_are_dealt_without_a_sample_of_the_sequences(spark, odd_docs):
    got = t.training_order(t.tokenise(odd_docs), length=64, rows=10)
    assert "rangepartitioning" not in got._jdf.queryExecution().toString()
    rows = [(r["shard"], r["p"]) for r in got.withColumn("p", F.spark_partition_id()).collect()]
    assert len(set(rows)) == len({s for s, _ in rows}) and rows == sorted(rows) and len({p for _, p in rows}) > 1
