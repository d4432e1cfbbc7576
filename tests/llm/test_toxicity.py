import zlib

import numpy as np
import pyarrow as pa

from pylonflow.llm import toxicity as t
from tests.llm.conftest import sentence

SMALL = t.Settings(max_train_rows=600, buckets=512, dims=8, filters=4, epochs=6)


def labelled(n):
    rng = np.random.default_rng(3)
    out = []
    for i in range(n):
        bad = bool(rng.random() < 0.3)
        words = sentence(int(rng.integers(1e6)), int(rng.integers(5, 60))).split()
        if bad:
            words.insert(int(rng.integers(len(words))), ["vile", "vilest", "rotten"][i % 3])
        out.append((i, " ".join(words), ["en", "de", None][i % 3], int(bad)))
    return out


def test_learns_held_out_rows_and_reruns_agree(spark):
    rows = labelled(900)
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, label int")
    train, test = df.where(~t.held_out(df["doc_id"])), df.where(t.held_out(df["doc_id"]))
    nets = [t.fit(train.select("text", "lang", "label"), SMALL) for _ in range(2)]
    assert np.array_equal(nets[0].embed, nets[1].embed) and set(nets[0].thresholds) == {"", "en", "de"}
    got = t.score(test, nets[0], {"label": test["label"]}).collect()
    right = np.mean([(r["score"] >= 0.5) == bool(r["label"]) for r in got])
    assert len(got) == sum(zlib.crc32(str(i).encode()) % 5 == 0 for i, *_ in rows) and right > 0.95


def test_scores_match_a_plain_convolution():
    rng = np.random.default_rng(1)
    net = t.train([rng.integers(1, 500, (12, 2)).astype(np.int32) for _ in range(20)], np.arange(20) % 2, SMALL)
    texts = ["", "one", "one two", "One TWO three four five-six", None, "x " * 300]
    codes, distinct, counts = t.coded_words(pa.array(texts), SMALL.buckets)
    got = t.score_texts(net, t.response_tables(net), codes, distinct, counts)
    at = 0
    for k, n in enumerate(counts.tolist()):
        e = np.zeros((n + 2, SMALL.dims), np.float32)
        pairs = distinct[codes[at:at + n]] if n else np.zeros((0, 2), int)
        e[:n] = net.embed[pairs[:, 0]] + net.embed[pairs[:, 1]]
        pooled = [max([0.0] + [sum(e[i + j] @ w[j][:, f] for j in range(len(w))) + b[f] for i in range(n)])
                  for w, b in zip(net.filters, net.bias, strict=True) for f in range(SMALL.filters)]
        want = 1 / (1 + np.exp(-(np.dot(pooled, net.out) + net.out_bias)))
        assert abs(got[k] - want) < 1e-4
        at += n


def test_odd_rows_and_empty_tables(spark, odd_docs, no_docs):
    rows = spark.createDataFrame(labelled(60), "doc_id long, text string, lang string, label int")
    net = t.fit(rows.select("text", "lang", "label"), SMALL)
    got = t.score(odd_docs, net, {"doc_id": odd_docs["doc_id"]}).collect()
    assert len(got) == odd_docs.count() and all(0 <= r["score"] <= 1 for r in got)
    assert len({r["score"] for r in got if r["doc_id"] in (3, 4, 5)}) == 1
    assert t.score(no_docs, net, {"doc_id": no_docs["doc_id"]}).count() == 0
    labels = spark.createDataFrame([(1, 0, 1), (1, 0, 0), (None, 0, 1), (2, 0, None)], "doc_id long, quality int, toxic int")
    assert {r["label"] for r in t.labelled_texts(odd_docs, labels).collect()} <= {1}
    assert t.fit(t.labelled_texts(no_docs, labels), SMALL) is None
    assert {r["score"] for r in t.score(odd_docs, None, {"doc_id": odd_docs["doc_id"]}).collect()} == {0.0}


def test_threshold_is_the_best_f1_cut():
    s, y = np.linspace(0, 1, 50), (np.linspace(0, 1, 50) > 0.7).astype(int)
    assert 0.68 < t.best_threshold(s, y) < 0.73
    assert t.best_threshold(s[:5], y[:5]) == 0.5 and t.best_threshold(s, np.zeros(50, int)) == 0.5


def test_copies_of_a_text_are_drawn_row_by_row_and_within_the_bounds(spark):
    rows = [(k, ["a vile thing here", "a kind thing here"][k % 2], "en", k % 2) for k in range(4000)]
    df = spark.createDataFrame(rows, "key long, text string, lang string, label int")
    few = t.fit(df, t.Settings(max_train_rows=100, buckets=512, dims=8, filters=4, least_steps=60))
    got = {r["text"]: r["score"] for r in t.score(df.dropDuplicates(["text"]), few, {"text": df["text"]}).collect()}
    assert got[rows[1][1]] > 0.5 > got[rows[0][1]]
    # without keys the rows are two; a label that the hash passes over still has one
    net = t.fit(df.drop("key"), t.Settings(max_train_rows=3000, max_train_chars=40, buckets=512, dims=8, filters=4, least_steps=60))
    assert net is not None


def test_one_label_only(spark):
    df = spark.createDataFrame([(k, sentence(k, 20), "en", 0) for k in range(50)], "key long, text string, lang string, label int")
    net = t.fit(df, SMALL)
    assert all(r["score"] < 0.5 for r in t.score(df, net, {"key": df["key"]}).collect())


def test_every_labelled_row_teaches_and_the_net_is_the_mean_of_its_parts(spark):
    # one rare word in a thousand rows is the only one that is toxic; a sample of 50 rows does not meet it
    rows = [(k, f"{sentence(k, 12)} {'vile' if k % 97 == 0 else 'kind'} word", "en", int(k % 97 == 0)) for k in range(1500)]
    df = spark.createDataFrame(rows, "key long, text string, lang string, label int")
    s = t.Settings(max_train_rows=50, buckets=512, dims=8, filters=4, calibration=10**6, least_steps=100)
    net = t.fit(df, s)
    met = {x for r in rows for w in r[1].split() for x in t._buckets_of(w.lower().encode(), 512)}
    moved = np.flatnonzero((net.embed != t.begun(0.5, s).embed).any(1))
    assert len(moved) > 0.9 * len(met) and set(moved.tolist()) <= met
    old, parts = t.begun(0.5, s), []
    for k in range(300):     # more parts than are added up in one group
        new = t.begun(0.5, s)
        new.embed[1 + k % 2] += k
        new.out_bias += 2.0 * k
        parts += [(k, *m) for m in t.moves_of(old, new)]
    mean = t.averaged(old, spark.createDataFrame(parts, "part int, chunk int, met binary, moved binary"), 300)
    assert np.allclose(mean.embed[1] - old.embed[1], np.mean(range(2, 300, 2)), rtol=1e-4) or np.allclose(mean.embed[1] - old.embed[1], np.mean(range(0, 300, 2)), rtol=1e-4)
    assert np.allclose(mean.embed[2] - old.embed[2], np.mean(range(1, 300, 2)), rtol=1e-4)
    assert np.isclose(mean.out_bias - old.out_bias, 299, rtol=1e-4) and np.array_equal(mean.filters[1], old.filters[1])


def test_thresholds_of_all_rows_are_those_of_the_sorted_arrays(spark):
    rng = np.random.default_rng(7)
    lang, y = rng.choice(["en", "de", "fr", "xx"], 3000, p=[0.6, 0.3, 0.096, 0.004]), rng.random(3000) < 0.2
    s = np.clip(np.round(rng.normal(0.3 + 0.3 * y, 0.2), 3), 0, 1)
    rows = list(zip(lang.tolist(), s.tolist(), t.score_bin(s).tolist(), y.astype(int).tolist(), strict=True))
    got = t.best_thresholds(spark.createDataFrame(rows, "lang string, score double, bin int, label int"))
    common = t.best_threshold(s, y.astype(int))
    assert got == {"": common} | {x: t.best_threshold(s[lang == x], y[lang == x].astype(int), common) for x in ("en", "de", "fr", "xx")}
    assert t.best_thresholds(spark.createDataFrame([], "lang string, score double, bin int, label int")) == {"": 0.5}


def test_buckets_are_kept_by_their_number():
    texts = pa.array(["one two three", "four"])
    assert t.coded_words(texts, 1 << 15)[1].max() > 512 >= t.coded_words(texts, 512)[1].max()


def shuffled(plan):
    """The columns of every shuffle below a node of a physical plan."""
    if plan.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
        plan = plan.initialPlan()
    if plan.getClass().getSimpleName() == "ShuffleExchangeExec":
        out = plan.output()
        yield {out.apply(k).name() for k in range(out.size())}
    below = plan.children()
    for k in range(below.size()):
        yield from shuffled(below.apply(k))


def test_no_text_is_shuffled_and_every_labelled_row_meets_its_label(spark, tmp_path, monkeypatch):
    rows = [(i, text, lang) for i, text, lang, _ in labelled(400)]
    rows += [rows[7]] * 30 + [(8, "another text of a known id", "en"), (None, "no id", "de"), (11, None, None), (11, "", "de"), (12, "", None)]
    flags = [(i, bad) for i, _, _, bad in labelled(400) if i % 3] + [(4, 0), (4, 1), (5, None), (None, 1), (9999, 1)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(flags, "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs, labels = (t.documents(spark, str(tmp_path), x) for x in ("documents", "labels"))
    small = t.Settings(max_train_rows=100, buckets=512, dims=8, filters=4, least_steps=60)
    frame, kept, nets = type(docs), [], []
    persist, fit = frame.persist, t.fit
    monkeypatch.setattr(frame, "persist", lambda df, *a: kept.append(df) or persist(df, *a))
    monkeypatch.setattr(t, "fit", lambda df, settings=None, **k: nets.append(fit(df, small, **k)) or nets[-1])
    wide = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")    # as with labels too many to broadcast
    try:
        got = t.op6_toxicity_cnn(spark, str(tmp_path))
        columns = list(shuffled(kept[0]._jdf.queryExecution().executedPlan()))
        plain = fit(t.labelled_texts(docs, labels), small)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", wide)
    assert sum("ids" in c for c in columns) == 1 and not any("text" in c for c in columns)
    assert np.array_equal(nets[0].embed, plain.embed) and np.array_equal(nets[0].out, plain.out) and nets[0].thresholds == plain.thresholds
    assert got.count() == len(rows)


def test_filter_of_hashes_passes_all_known_rows_and_few_others(spark, monkeypatch):
    rows = spark.range(8000).selectExpr("id", "xxhash64(id) h")
    known = rows.where("id % 4 = 0").select("h")
    got = [r["id"] for r in t.among(rows, known, 2000).select("id").collect()]
    assert len(got) == len(set(got)) < 2000 + 6000 / 6 and {i for i in range(8000) if i % 4 == 0} <= set(got)
    monkeypatch.setattr(t, "FILTER_WORDS", 4)      # full: it lets others through, but loses none
    assert {i for i in range(8000) if i % 4 == 0} <= {r["id"] for r in t.among(rows, known, 2000).collect()}
    assert t.among(rows, known.limit(0), 0).count() == 0
