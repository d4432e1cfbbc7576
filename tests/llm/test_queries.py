"""Every registered query with SQL against DuckDB, and the pipeline against a brute-force version."""

import hashlib
import re
import zlib
from collections import Counter

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from pylonflow.llm import queries
from tests.conftest import SF001
from tests.llm import test_decontaminate, test_jaccard, test_mixing, test_sharding
from tests.llm.conftest import DOCS, doc, sentence
from tests.oracle_compare import duck, fingerprint


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_matches_sql(spark, name):
    a = fingerprint(queries.QUERIES[name](spark, SF001).toPandas())
    b = fingerprint(duck(SF001).execute(queries.ORACLE[name]).df())
    assert a[:3] == b[:3], sorted(set(a[3]) ^ set(b[3]))[:4]


def test_one_query_for_each_operator():
    numbers = [int(n[2:].split("_")[0]) for n in queries.QUERIES]
    assert sorted(numbers) == list(range(1, 14)) and set(queries.QUERIES) < set(entry.queries()) and "pipeline" in entry.queries()


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    docs = [doc(i, t, "en", f"s{i % 3}") for i, t in test_jaccard.near_copies(4, groups=3, size=8)]
    bench = [(1, sentence(50, 14)), (2, sentence(60, 30))]
    docs += [doc(20_000 + k, f"own{k} " + sentence(100 + k, 30) + (" " + bench[k % 2][1] if k % 4 == 0 else ""), None, [None, "s1"][k % 2]) for k in range(24)]
    docs += [doc(30_000, None), doc(30_001, "# # # # " * 20), doc(30_002, "too short"), doc(None, sentence(900, 40)), docs[-1], docs[-1]]
    root = str(tmp_path_factory.mktemp("corpus"))
    spark.createDataFrame(docs, DOCS).repartition(3).write.parquet(f"{root}/documents.parquet")
    spark.createDataFrame(bench, "item_id long, text string").write.parquet(f"{root}/benchmark.parquet")
    return docs, bench, root


def test_pipeline_matches_brute_force(spark, corpus):
    docs, bench, root = corpus
    from pylonflow.llm import mixing, quality
    table, stages = spark.read.parquet(f"{root}/documents.parquet"), dict(corpus_pipeline.STAGES)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "ngram_jaccard_join", "benchmark_decontamination", "source_mixing", "hash_tree_sharding"]

    rules = quality.default_rules()
    kept = [d for d in docs if not any(r.rejects(quality.Text(d[1].encode() if d[1] else None)) for r in rules)]
    got = stages["quality_rules"](spark, table, root)
    assert Counter(map(tuple, got.collect())) == Counter(kept) and got.schema == table.schema

    best = {i for i, _, c in test_jaccard.brute([(d[0], d[1]) for d in kept]) if i is not None and i == c}
    once = list(dict.fromkeys(d for d in kept if d[0] in best)) + [d for d in kept if d[0] is None]
    got = stages["ngram_jaccard_join"](spark, spark.createDataFrame(kept, DOCS), root)
    assert Counter(map(tuple, got.collect())) == Counter(once) and len(once) < len(kept)

    clean = [d for d in once if not test_decontaminate.brute(d[1], bench)[1]]
    got = stages["benchmark_decontamination"](spark, spark.createDataFrame(once, DOCS), root)
    assert Counter(map(tuple, got.collect())) == Counter(clean) and len(clean) < len(once)

    cleaned = spark.createDataFrame(clean, DOCS)
    copies = {r["doc_id"]: r["copies"] for r in mixing.mix_documents(cleaned).collect()}
    mixed = [d for d in clean for _ in range(copies[None if d[0] is None else str(d[0])])]
    got = stages["source_mixing"](spark, cleaned, root)
    assert Counter(map(tuple, got.collect())) == Counter(mixed) and got.columns == table.columns

    final = corpus_pipeline.run(spark, root).collect()
    tree = test_sharding.s.even_tree()
    want = Counter((d[0], len(d[1].encode()) + 1, zlib.crc32(d[1].encode()),
                    test_sharding.descend("" if d[0] is None else d[0], tree)) for d in mixed)
    assert Counter((r["doc_id"], r["size"], r["text_crc32"], r["shard"]) for r in final) == want


def test_decontamination_keeps_clean_rows_of_a_dirty_id(spark, corpus):
    _, bench, root = corpus
    dirty, clean = "own " + bench[0][1], sentence(900, 40)
    docs = [doc(None, dirty), doc(None, clean), doc(None, clean), doc(7, dirty), doc(7, clean), doc(8, None), doc(None, None), doc(9, dirty)]
    got = dict(corpus_pipeline.STAGES)["benchmark_decontamination"](spark, spark.createDataFrame(docs, DOCS), root)
    want = [d for d in docs if d[1] != dirty]
    assert Counter(map(tuple, got.collect())) == Counter(want) and got.columns == DOCS.names


def test_mixing_stage_takes_the_copies_of_equal_rows_once(spark):
    from pylonflow.llm import mixing
    docs = [doc(None, sentence(1, 20), "en", "b")] * 1000 + [doc(None, sentence(2, 30), lang, "b") for lang in "xyyy" * 25]
    docs += [doc(k, sentence(k, 40), "en", "a") for k in range(5)] + [doc(9, sentence(3, 8), "en", "c")] * 2
    table = spark.createDataFrame(docs, DOCS)
    want = Counter()
    for r in mixing.mix_documents(table).collect():
        want[r["doc_id"], r["size"]] += r["copies"]
    assert want[None, 20] % 1000 and want[None, 30] % 100   # rates that are not whole
    got = dict(corpus_pipeline.STAGES)["source_mixing"](spark, table, "").collect()
    assert Counter((None if r["doc_id"] is None else str(r["doc_id"]), len(r["text"].split())) for r in got) == +want
    langs = Counter(r["lang"] for r in got if len(r["text"].split()) == 30)
    assert abs(langs["y"] - 3 * langs["x"]) <= 4 and set(map(tuple, got)) <= set(docs)


def test_pipeline_of_an_empty_table(spark, no_docs, tmp_path):
    no_docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_jaccard_stage_keeps_every_distinct_row_of_an_id(spark):
    t, u = sentence(1, 60), sentence(2, 60)
    docs = [doc(1, t, "en", "a"), doc(1, t, "de", "b"), doc(1, t, "de", "b"), doc(2, t, "en", "a"), doc(3, u), doc(None, u), doc(None, u)]
    got = dict(corpus_pipeline.STAGES)["ngram_jaccard_join"](spark, spark.createDataFrame(docs, DOCS), "")
    assert Counter(map(tuple, got.collect())) == Counter([docs[0], docs[1], docs[4], docs[5], docs[5]])


def _documents(spark):
    return spark.read.parquet(f"{SF001}/documents.parquet").collect()


def test_op5_matches_a_plain_version_of_every_column(spark):
    from tests.llm import test_pii
    kinds = ["email", "ip", "card", "phone"]
    got = {r["doc_id"]: r for r in queries.QUERIES["op5_pii"](spark, SF001).collect()}
    docs = _documents(spark)
    assert len(got) == len(docs)
    for d in docs:
        base = test_pii.brute(d["text"] or "")
        listed = [f"{kinds[k]}:{a}:{b}" for a, k, b in base]
        r = got[d["doc_id"]]
        assert r["base_sha256"] == hashlib.sha256(",".join(listed).encode()).hexdigest()
        spans = [x for x in r["spans"].split(",") if x]
        added = sorted(set(spans) - set(listed))
        assert set(listed) <= set(spans) and spans == sorted(spans, key=lambda x: (int(x.split(":")[1]), kinds.index(x.split(":")[0])))
        for k, name in enumerate(kinds):
            assert r[f"n_{name}"] == sum(x.startswith(name + ":") for x in spans)
        assert added == []      # nothing to discover in the given tables, as README says


def test_op6_marks_the_held_out_rows_and_scores_every_text(spark):
    got = {r["doc_id"]: r for r in queries.QUERIES["op6_toxicity_cnn"](spark, SF001).collect()}
    docs = _documents(spark)
    assert len(got) == len(docs)
    by_text = {}
    for d in docs:
        r = got[d["doc_id"]]
        assert r["held_out"] == (zlib.crc32(str(d["doc_id"]).encode()) % 5 == 0)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5)
        assert by_text.setdefault(d["text"] or "", r["score"]) == r["score"]


def test_op7_meets_every_target(spark):
    got = {r["doc_id"]: r for r in queries.QUERIES["op7_entropy_mixing"](spark, SF001).collect()}
    docs = _documents(spark)
    size = {d["doc_id"]: len([w for w in re.split("[\x20\x09-\x0D]+", d["text"] or "") if w]) for d in docs}
    sources = {}
    for d in docs:
        sources.setdefault(d["source"], []).append(d["doc_id"])
    order = sorted((s for s in sources if s is not None), key=lambda s: s.encode()) + [None] * (None in sources)
    want = test_mixing.waterfill([sum(size[i] for i in sources[s]) for s in order], [(5, 2, 1)[k % 3] for k in range(len(order))], 3.0)
    for s, target in zip(order, want, strict=True):
        mine = [got[i] for i in sources[s]]
        assert all(r["size"] == size[r["doc_id"]] and 0 <= r["taken"] <= 3 * r["size"] and r["source_size"] == sum(x["size"] for x in mine) for r in mine)
        assert all(abs(r["target"] - target) <= 1e-6 * max(target, 1) for r in mine)
        assert abs(sum(r["taken"] for r in mine) - target) <= max(r["size"] for r in mine)
