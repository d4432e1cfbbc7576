import math
import re

import pytest

from pylonflow.llm import url_filter as u

URLS = [None, "", "no scheme", "http://", "https://WWW.Example.COM/en/x?y#z", "http://example.com/en/", "http://a.example.com/en",
        "http://anexample.com/en/", "ftp://x.net/es/1", "http://net/fr/", "http://x.org#a://b/c", "http://h?q=/en/", "a://b://c/d",
        "http://x.net/de/ß?a=1&b=2", "http://x.com", "http://x.com/" + "a/" * 5000, "http://ü.com/\n/en/?x"]


def brute(url):
    if not url or "://" not in url:
        return "", "", None, None
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host):])[0]
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = [r for r in u.RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    best = max(fits, key=lambda r: len(r.name), default=None)
    return host, path, best and best.name, best and best.verdict


def test_hosts_paths_and_rules_match_brute_force(spark):
    df = spark.createDataFrame([(k, url, "x", "y") for k, url in enumerate(URLS)], "page_id long, url string, host string, verdict string")
    got = {r["page_id"]: r for r in u.filter_urls(df).collect()}
    assert len(got) == len(URLS)
    for k, url in enumerate(URLS):
        host, path, rule, verdict = brute(url)
        assert (got[k]["host"], got[k]["path"], got[k]["rule"]) == (host, path, rule)
        assert got[k]["verdict"] in ("allow", "block") and (verdict is None or got[k]["verdict"] == verdict)


def test_trees_learn_held_out_labels(spark):
    rows = [(k, f"http://{'bad-' * (k % 2)}{k % 17}site{k % 23}.org/{'x/' * (k % 4)}{k * 7919 % 1000}{'?a=1&b=2&c=3' if k % 2 else ''}", k % 2) for k in range(900)]
    df = u.prepared(spark.createDataFrame(rows, "page_id long, url string, label int"), "page_id", "url", ())
    df = df.withColumn("label", df["page_id"] % 2)
    assembler, model, rates = u.train(df.where("page_id < 600"), trees=5)
    got = model.transform(assembler.transform(u._with_rates(df.where("page_id >= 600"), rates)))
    assert got.where("prediction = label").count() > 285


def test_features(spark):
    df = u.prepared(spark.createDataFrame([(1, "https://a-1.b.org/x/y?p=1&q=2#f"), (2, None), (3, "aab")], "page_id long, url string"), "page_id", "url", u.RULES)
    got = {r["page_id"]: r for r in df.collect()}
    r = got[1]
    assert (r["url_length"], r["host_length"], r["path_length"], r["depth"], r["parameters"], r["hyphens"], r["labels"], r["fragment"], r["secure"]) == (31, 9, 4, 2, 2, 1, 2, 1, 1)
    assert math.isclose(r["digit_ratio"], 3 / 31) and r["host_digits"] == 1
    assert math.isclose(got[3]["entropy"], -(2 / 3 * math.log2(2 / 3) + 1 / 3 * math.log2(1 / 3)))
    assert got[2]["entropy"] == 0 and got[2]["parameters"] == 0


@pytest.mark.parametrize("urls,verdict", [([], None), (["http://x.org/a"], "allow"), (["http://x.net/es/1", "http://y.org/"], "block")])
def test_without_two_labels(spark, urls, verdict):
    df = spark.createDataFrame([(k, x) for k, x in enumerate(urls)], "page_id long, url string")
    assert {r["verdict"] for r in u.filter_urls(df).collect()} == ({verdict} if verdict else set())


def test_main_path_runs_no_python(spark):
    plan = u.op4_url_filter(spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_suffix_rates_come_from_all_labelled_rows(spark):
    rows = [(k, f"http://a.d{k % 900}.org/s{k % 700}/x", int(k % 900 < 300)) for k in range(3600)]
    df = u.prepared(spark.createDataFrame([r[:2] for r in rows], "page_id long, url string"), "page_id", "url", ())
    df = df.withColumn("label", (df["page_id"] % 900 < 300).cast("int"))
    _, _, (table, overall) = u.train(df, max_train_rows=100, trees=1, depth=1)
    got = {r["suffix"]: r["rate"] for r in table.where("name = 'domain'").collect()}
    assert math.isclose(overall, 1 / 3) and len(got) == 900
    for k in range(900):   # each domain has its own rate, from its own four rows
        assert math.isclose(got[f"d{k}.org"], ((4 if k < 300 else 0) + u.PRIOR / 3) / (4 + u.PRIOR))
    assert u._with_rates(df, (table, overall)).count() == 3600


def test_a_rare_label_stays_in_the_sample(spark):
    rows = [(1, "http://x.net/es/1")] * 3 + [(k, f"http://x{k}.org/") for k in range(3000)]
    df = u.prepared(spark.createDataFrame(rows, "page_id long, url string"), "page_id", "url", u.RULES)
    df = df.withColumn("label", df["url"].contains("/es/").cast("int"))
    drawn = u._drawn(df, {0: 3000, 1: 3}, 20)
    got = {}
    for r in drawn.collect():
        n, w = got.get(r["label"], (0, 0.0))
        got[r["label"]] = (n + 1, w + r["weight"])
    assert got[1][0] == 3 and 0 < got[0][0] < 60 and math.isclose(got[1][1], 3) and math.isclose(got[0][1], 3000)


def test_training_rates_leave_out_the_own_domain_and_unknown_hosts_are_judged(spark):
    # the path tells, and so does the host; a host is in one fold only
    rows = [(k, f"http://h{k % 30}.org/{'x/' * (5 if k % 30 < 10 else 1)}{k}?{'a=1&' * (4 if k % 30 < 10 else 0)}") for k in range(1200)]
    df = u.prepared(spark.createDataFrame(rows, "page_id long, url string"), "page_id", "url", ())
    df = df.withColumn("label", (df["page_id"] % 30 < 10).cast("int")).cache()
    rates = u._suffix_rates(df)
    one = u._with_rates_elsewhere(df.where("page_id = 3"), df, rates).first()
    assert math.isclose(one["domain_rate"], 1 / 3) and math.isclose(one["tld_rate"], (400 - 40 + 10 / 3) / (1200 - 40 + 10))
    got = u.accuracy_elsewhere(df, 3)
    assert sum(n for _, n, _, _ in got) == 1200 and all(right == n for _, n, right, _ in got)
    model = u.train(df, trees=3)[1]
    weight = dict(zip(u.feature_names(), model.featureImportances.toArray(), strict=True))
    assert weight["parameters"] + weight["depth"] + weight["path_length"] + weight["url_length"] > 0.5 and weight["domain_rate"] == 0
    df.unpersist()
