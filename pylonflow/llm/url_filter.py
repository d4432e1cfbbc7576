"""URL filters: rule list first, gradient-boosted trees on lexical features for the rest.

Host and path are cut from the URL; a rule fits its host and all
subdomains where the path starts with the rule's, and the longest rule wins.
URLs that a rule judges are the labelled ones: a bounded part of them
(``max_train_rows``, drawn from each label by a hash of the row, and weighted
back to the label's share) trains the trees, which judge every URL that no
rule fits.

Features: lengths, path depth, digit ratio, character entropy, counts of
parameters, hyphens and labels, scheme, and suffix statistics (the smoothed
block rate of all labelled URLs that share the top-level domain, the last two
host labels or the first path segment; the overall rate where none does),
joined by the suffix. A training row's rates leave out all URLs of its own
registered domain, as if its host were unknown. Everything is DataFrame expressions and spark.ml.

A null URL, or one without ``://``, has empty host and path and is judged by
the model. Every input row gives one output row; only the named columns are
read. Without labelled URLs, or with one label only, the model's verdict is
that label (allow without any).
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pylonflow.llm.common import LOWER, UPPER, documents, stored

PRIOR = 10.0     # rows' worth of the overall block rate mixed into a suffix's rate


@dataclass(frozen=True)
class UrlRule:
    verdict: str   # allow or block
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


# The rules of the contract.
RULES = (UrlRule("allow", "com", "/"), UrlRule("block", "example.com", "/en/"), UrlRule("allow", "www.example.com", "/en/"),
         UrlRule("block", "net", "/es/"), UrlRule("block", "net", "/fr/"))


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), UPPER, LOWER)
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: tuple[UrlRule, ...]) -> tuple[Column, Column]:
    """Name and verdict of the longest rule that fits, else null."""
    name = verdict = None
    for r in sorted(rules, key=lambda r: (-len(r.name), r.name)):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        name = F.when(fits, r.name) if name is None else name.when(fits, r.name)
        verdict = F.when(fits, r.verdict) if verdict is None else verdict.when(fits, r.verdict)
    none = F.lit(None).cast("string")
    return (none, none) if name is None else (name, verdict)


def _count(text: Column, what: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(what), F.lit("")))


def _entropy(text: Column) -> Column:
    n = F.length(text).cast("double")
    part = lambda c: (n - F.length(F.replace(text, c, F.lit("")))) / n
    chars = F.filter(F.array_distinct(F.split(text, "")), lambda c: c != "")
    return F.when(n > 0, F.aggregate(chars, F.lit(0.0), lambda a, c: a - part(c) * F.log2(part(c)))).otherwise(0.0)


SUFFIXES = {
    "tld": lambda host, path: F.element_at(F.split(host, r"\."), -1),
    "domain": lambda host, path: F.substring_index(host, ".", -2),
    "segment": lambda host, path: F.regexp_extract(path, r"^/([^/]*)", 1),
}


def lexical_features(url: Column, host: Column, path: Column) -> dict[str, Column]:
    u = F.coalesce(url, F.lit(""))
    size = F.length(u)
    return {
        "url_length": size, "host_length": F.length(host), "path_length": F.length(path), "depth": _count(path, "/"),
        "digit_ratio": F.when(size > 0, (size - F.length(F.translate(u, "0123456789", ""))) / size).otherwise(0.0),
        "host_digits": F.length(host) - F.length(F.translate(host, "0123456789", "")),
        "entropy": _entropy(u), "host_entropy": _entropy(host),
        "parameters": F.when(F.instr(u, "?") > 0, _count(u, "&") + 1).otherwise(0),
        "hyphens": _count(host, "-"), "labels": _count(host, "."), "fragment": (F.instr(u, "#") > 0).cast("int"),
        "secure": u.startswith("https").cast("int"),
    }


def _suffix_rates(labelled: DataFrame) -> tuple[DataFrame, float]:
    """Stored (name, suffix, rate) of every suffix of all labelled rows, and the overall block rate."""
    overall = float(labelled.agg(F.avg("label")).first()[0] or 0.0)
    each = F.explode(F.array(*[F.struct(F.lit(n).alias("name"), F.col(f"{n}_suffix").alias("suffix")) for n in SUFFIXES]))
    got = labelled.select("label", each.alias("s")).groupBy("s.name", "s.suffix").agg(F.sum("label").alias("hits"), F.count("*").alias("n"))
    return stored(got.select("name", "suffix", "hits", "n", ((F.col("hits") + PRIOR * overall) / (F.col("n") + PRIOR)).alias("rate")), "rates"), overall


def _with_rates(df: DataFrame, rates: tuple[DataFrame, float]) -> DataFrame:
    table, overall = rates
    for n in SUFFIXES:
        mine = table.where(F.col("name") == n).select(F.col("suffix").alias(f"{n}_suffix"), F.col("rate").alias(f"{n}_rate"))
        df = df.join(mine, f"{n}_suffix", "left").withColumn(f"{n}_rate", F.coalesce(f"{n}_rate", F.lit(overall)))
    return df


def _with_rates_elsewhere(df: DataFrame, labelled: DataFrame, rates: tuple[DataFrame, float]) -> DataFrame:
    """Rates as a row would find them if no labelled URL of its own registered domain were known.

    The trees learn from these: a rate that holds the row's own label, or its host's, would teach them to repeat it.
    """
    table, overall = rates
    for n in SUFFIXES:
        all_ = table.where(F.col("name") == n).select(F.col("suffix").alias(f"{n}_suffix"), F.col("hits").alias("_hits"), F.col("n").alias("_n"))
        own = labelled.groupBy(*{f"{n}_suffix", "domain_suffix"}).agg(F.sum("label").alias("_own_hits"), F.count("*").alias("_own_n"))
        df = df.join(all_, f"{n}_suffix", "left").join(own, list({f"{n}_suffix", "domain_suffix"}), "left")
        left = lambda of: F.coalesce(f"_{of}", F.lit(0)) - F.coalesce(f"_own_{of}", F.lit(0))
        df = df.withColumn(f"{n}_rate", (left("hits") + PRIOR * overall) / (left("n") + PRIOR)).drop("_hits", "_n", "_own_hits", "_own_n")
    return df


def prepared(df: DataFrame, key: str, url: str, rules: tuple[UrlRule, ...]) -> DataFrame:
    d = df.select(F.col(key).alias("page_id"), F.col(url).cast("string").alias("url"))
    host, path = host_and_path(F.col("url"))
    d = d.withColumn("host", host).withColumn("path", path)
    name, verdict = rule_of(F.col("host"), F.col("path"), rules)
    d = d.withColumns({"rule": name, "by_rule": verdict})
    d = d.withColumns(lexical_features(F.col("url"), F.col("host"), F.col("path")))
    return d.withColumns({f"{n}_suffix": f(F.col("host"), F.col("path")) for n, f in SUFFIXES.items()})


def feature_names() -> list[str]:
    return [*lexical_features(F.lit(""), F.lit(""), F.lit("")), *[f"{n}_rate" for n in SUFFIXES]]


def _drawn(labelled: DataFrame, labels: dict[int, int], max_train_rows: int) -> DataFrame:
    """About ``max_train_rows`` rows, some of either label, with the weight that gives each label its share of all rows."""
    scale, rarer = 1 << 30, min(labels, key=labels.get)
    few = max(1, min(labels[rarer], max_train_rows // 2))
    quota = {k: few if k == rarer else max(1, min(n, max_train_rows - few)) for k, n in labels.items()}
    at = F.pmod(F.xxhash64("url", "page_id"), F.lit(scale))
    share = lambda k: labelled.where((F.col("label") == k) & (at < math.ceil(scale * quota[k] / labels[k])))
    parts = []
    for k in sorted(labels):
        part = share(k)
        n = part.count()
        if not n:   # the hash passes over the label, as where all its rows are alike: the rows with the smallest hashes
            part = labelled.where(F.col("label") == k).orderBy(at, "url", "page_id").limit(quota[k])
            n = quota[k]
        parts.append(part.withColumn("weight", F.lit(labels[k] / n)))
    return parts[0].unionByName(parts[1])


def train(labelled: DataFrame, max_train_rows: int = 20_000, trees: int = 20, depth: int = 4):
    """(assembler, model, rates), or the single label there is (0.0 without any).

    ``labelled`` is ``prepared`` rows with ``label`` (1 is block).
    """
    labels = {r["label"]: r["n"] for r in labelled.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if len(labels) < 2:
        return float(next(iter(labels), 0))
    rates = _suffix_rates(labelled)
    drawn = stored(_drawn(labelled, labels, max_train_rows), "urls")
    assembler = VectorAssembler(inputCols=feature_names(), outputCol="features")
    rows = assembler.transform(_with_rates_elsewhere(drawn, labelled, rates)).select("features", "weight", F.col("label").cast("double").alias("label"))
    model = GBTClassifier(maxIter=trees, maxDepth=depth, seed=7, labelCol="label", weightCol="weight").fit(rows)
    return assembler, model, rates


def accuracy_elsewhere(labelled: DataFrame, folds: int = 3, max_train_rows: int = 20_000) -> list[tuple[int, int, int, int]]:
    """(fold, rows, rows judged right, rows of the fold's larger label) by registered domain: each fold's domains are
    judged by a model that has seen none of their URLs."""
    out, fold = [], F.pmod(F.xxhash64("domain_suffix"), F.lit(folds))
    for k in range(folds):
        test = labelled.where(fold == k)
        fitted = train(labelled.where(fold != k), max_train_rows)
        if isinstance(fitted, float):
            judged = test.withColumn("prediction", F.lit(fitted))
        else:
            assembler, model, rates = fitted
            judged = model.transform(assembler.transform(_with_rates(test, rates)))
        r = judged.agg(F.count("*"), F.count(F.when(F.col("prediction") == F.col("label"), 1)), F.coalesce(F.sum("label"), F.lit(0))).first()
        out.append((k, r[0], r[1], max(r[2], r[0] - r[2])))
    return out


def filter_urls(df: DataFrame, key: str = "page_id", url: str = "url", rules: tuple[UrlRule, ...] = RULES,
                max_train_rows: int = 20_000) -> DataFrame:
    """(page_id, host, path, rule, verdict, block_score) of every row."""
    rows = prepared(df, key, url, rules)
    labelled = rows.where("by_rule IS NOT NULL").withColumn("label", (F.col("by_rule") == "block").cast("int"))
    fitted = train(labelled, max_train_rows)
    if isinstance(fitted, float):
        judged = rows.withColumn("block_score", F.lit(fitted))
    else:
        from pyspark.ml.functions import vector_to_array
        assembler, model, rates = fitted
        judged = model.transform(assembler.transform(_with_rates(rows, rates))).withColumn(
            "block_score", vector_to_array("probability")[1])
    by_model = F.when(F.col("block_score") >= 0.5, "block").otherwise("allow")
    return judged.select("page_id", "host", "path", "rule", F.coalesce("by_rule", by_model).alias("verdict"), "block_score")


def op4_url_filter(spark, sf_dir: str) -> DataFrame:
    return filter_urls(documents(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict")
