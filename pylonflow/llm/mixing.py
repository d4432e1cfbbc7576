"""Mixing sources to target weights by entropy balancing.

Every document gets a rate, the expected number of its copies. Rates stay
as close to one copy each as the token constraints allow: they minimise
``sum(r ln r - r)`` over ``0 <= r <= cap`` subject to ``sum(r * size)``
over a source being that source's target. The solution is exponentially
tilted, ``r = min(cap, exp(tilt * size / mean size))``, with one tilt a source,
the minimiser of the convex dual. Newton iterations find all tilts at once:
each is one Spark aggregation over the (source, size) histogram, whose rows
are far fewer than the documents, and a bisection bracket guards each step.

Rates are then rounded into whole copies: documents are dealt into bounded
buckets of their source, and within a bucket, largest first, each is
rounded up or down, whichever leaves the running token error smaller. The
error left by a bucket is about one of its smallest documents.

Null texts hold no words, a null source is a source (ordered last), and
every input row gives one output row, repeated ids included. Only the named
columns are read. Without any word all targets, and all copies, are 0.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pylonflow.llm.common import SPACE_WORD, documents, global_index, stored
from pylonflow.session import ship_package

BUCKET = 4096        # documents a rounding bucket holds on average
PART = 512           # of them, equal rows that go there together at most
ROUNDS = 500         # Newton rounds after which something is wrong: a bracket doubles or halves in each


def word_count(text: Column) -> Column:
    """Number of maximal runs of characters other than the six ASCII white spaces; null: 0."""
    return F.coalesce(F.regexp_count(text, F.lit(SPACE_WORD)), F.lit(0)).cast("long")


def target_table(sizes: DataFrame, weights: tuple[float, ...] = (5.0, 2.0, 1.0), cap: float = 3.0) -> DataFrame:
    """(source, source_size, docs, target) of a (source, size, docs) histogram.

    Sources in code-point order, null last, take the weights in turn. Shares
    above ``cap`` times a source's size stop there, and the excess is shared by
    weight among the rest, again and again: each round is one aggregation.
    """
    by = sizes.groupBy("source").agg(F.sum(F.col("size") * F.col("docs")).alias("source_size"),
                                     F.sum("docs").alias("docs"))
    ranked = global_index(by.withColumn("_null", F.col("source").isNull()).withColumn("_name", F.col("source").cast("binary")),
                          ["_null", "_name"], "_rank")
    table = F.array(*[F.lit(float(w)) for w in weights])
    t = stored(ranked.select("source", "source_size", "docs",
                             table[F.pmod(F.col("_rank"), F.lit(len(weights))).cast("int")].alias("weight")), "sources")
    total = t.agg(F.sum("source_size")).first()[0] or 0
    level = 0.0   # every free source gets weight * level
    while True:   # the level only rises, each round stops at least one more source, or ends
        stopped = F.col("weight") * F.lit(level) > cap * F.col("source_size")
        r = t.agg(F.sum(F.when(stopped, cap * F.col("source_size"))).alias("fixed"),
                  F.sum(F.when(~stopped, F.col("weight"))).alias("free")).first()
        if not r["free"]:
            break
        higher = (total - (r["fixed"] or 0.0)) / r["free"]
        if higher <= level:
            break
        level = higher
    # stopped exactly at the cap
    return t.withColumn("target", F.least(F.col("weight") * F.lit(level), cap * F.col("source_size").cast("double")))


def tilt_table(sizes: DataFrame, targets: DataFrame, cap: float = 3.0, tolerance: float = 1e-9) -> DataFrame:
    """``targets`` with every source's ``mean`` size and ``tilt`` (the dual's minimiser).

    Safeguarded Newton: the taken tokens rise with the tilt, so every round moves one end of a bracket around the
    root. A step may not leave the bracket (it is halved instead), and where the bracket is still open on that side a
    step may at most double the tilt: the root is found however far out it is. Sources whose target is all they have
    at the cap have an infinite tilt, those whose target is nothing an infinitely negative one. A source that is not
    within ``tolerance`` after ``ROUNDS`` rounds is an error, never an answer.
    """
    full = F.col("target") >= cap * F.col("source_size") * (1 - 1e-12)
    none = F.col("target") <= 0
    open_end = F.lit(None).cast("double")
    state = targets.select(
        "source", "source_size", "docs", "target", (F.col("source_size") / F.col("docs")).alias("mean"),
        F.when(none, float("-inf")).when(full, float("inf")).otherwise(0.0).alias("tilt"),
        open_end.alias("low"), open_end.alias("high"), (full | none).alias("done"))
    state = stored(state, "tilt")
    for _ in range(ROUNDS):
        if state.where(~F.col("done")).isEmpty():
            return state
        raw = F.exp(F.col("tilt") * F.col("size") / F.col("mean"))
        x = sizes.alias("h").join(state.where(~F.col("done")).alias("t"),
                                  F.col("h.source").eqNullSafe(F.col("t.source")))
        moved = (x.select("t.source", "size", F.col("h.docs").alias("n"), raw.alias("raw"), "mean")
                 .groupBy("source").agg(
                     F.sum(F.col("n") * F.col("size") * F.least(F.col("raw"), F.lit(cap))).alias("taken"),
                     F.sum(F.when(F.col("raw") < cap, F.col("n") * F.col("size") * F.col("size") / F.col("mean")
                                  * F.col("raw")).otherwise(0.0)).alias("slope")))
        s, m = state.alias("s"), moved.alias("m")
        error = F.col("taken") - F.col("target")
        nxt = s.join(m, F.col("s.source").eqNullSafe(F.col("m.source")), "left").select(
            "s.source", "source_size", "docs", "target", "mean", "done", "tilt", error.alias("error"), "slope",
            F.when(error < 0, F.col("tilt")).otherwise(F.col("low")).alias("low"),
            F.when(error > 0, F.col("tilt")).otherwise(F.col("high")).alias("high"))
        reach = F.abs("tilt") + 1
        newton = F.when(F.col("slope") > 0, F.col("tilt") - F.col("error") / F.col("slope")).otherwise(
            F.when(F.col("error") < 0, float("inf")).otherwise(float("-inf")))
        step = F.least(F.greatest(newton, F.col("tilt") - reach), F.col("tilt") + reach)
        both = F.col("low").isNotNull() & F.col("high").isNotNull()
        inside = (F.col("low").isNull() | (step > F.col("low"))) & (F.col("high").isNull() | (step < F.col("high")))
        tight = both & (F.col("high") - F.col("low") <= 1e-13 * (1 + F.abs("tilt")))
        stop = F.col("done") | (F.abs("error") <= tolerance * F.col("target")) | tight
        state = stored(nxt.select(
            "source", "source_size", "docs", "target", "mean",
            F.when(stop, F.col("tilt")).when(inside, step).otherwise((F.col("low") + F.col("high")) / 2).alias("tilt"),
            "low", "high", stop.alias("done")), "tilt")
    raise RuntimeError(f"some source's tilt is not found after {ROUNDS} rounds")


def _round_bucket(group: pd.DataFrame, cap: float = 3.0) -> pd.DataFrame:
    """Copies of one bucket's documents, largest first, by feedback of the token error; equal rows are told apart here."""
    g = group.loc[group.index.repeat(group["n"])]
    g = g.sort_values(["size", "mix", "doc_id"], ascending=[False, True, True], kind="stable")
    size = g["size"].to_numpy(np.int64)
    mean, tilt = g["mean"].to_numpy(float), g["tilt"].to_numpy(float)
    with np.errstate(over="ignore", invalid="ignore", divide="ignore"):
        at = np.where(size > 0, tilt * size / mean, 0.0)
        rate = np.minimum(cap, np.exp(np.minimum(at, 700.0)))
    floor = np.floor(rate).astype(np.int64)
    part = (rate - floor) * size
    copies, error = floor.copy(), 0.0
    for k in range(len(size)):
        error += part[k]
        if part[k] > 0 and 2 * error > size[k]:
            copies[k] += 1
            error -= size[k]
    g["copies"] = np.where(size > 0, copies, 0)
    return g[["doc_id", "row", "size", "source_size", "target", "copies"]]


def mix_documents(df: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source",
                  weights: tuple[float, ...] = (5.0, 2.0, 1.0), cap: float = 3.0) -> DataFrame:
    """Every input row with its size, its source's size and target, and ``copies``.

    ``row`` is the row's hash of key, source and text: it joins the copies to
    rows that share a key. Texts are scanned once; all shuffles carry numbers.
    """
    spark = df.sparkSession
    ship_package(spark)
    rows = stored(df.select(F.col(key).cast("string").alias("doc_id"), F.col(source).cast("string").alias("source"),
                            word_count(F.col(text)).alias("size"), row_hash(key, source, text).alias("row")), "mix")
    sizes = stored(rows.groupBy("source", "size").agg(F.count("*").alias("docs")), "sizes")
    tilts = tilt_table(sizes, target_table(sizes, weights, cap), cap)
    # equal rows are counted before the shuffle and dealt out in parts, so that a flood of them fills many buckets
    same = rows.groupBy("source", "doc_id", "row", "size").agg(F.count("*").alias("all"))
    part = F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("all") - 1) / PART)))
    same = same.select("*", part.alias("part")).withColumn("n", F.least(F.lit(PART), F.col("all") - F.col("part") * PART))
    x = same.alias("r").join(tilts.alias("t"), F.col("r.source").eqNullSafe(F.col("t.source")))
    x = x.select("r.doc_id", "r.row", "size", "n", F.col("r.source").alias("source"), "source_size", "target", "mean", "tilt",
                 F.xxhash64("doc_id", "r.row", "part").alias("mix"),
                 F.pmod(F.xxhash64("doc_id", "r.row", "part", F.lit(7)), F.ceil(F.col("docs") / BUCKET)).alias("bucket"))
    return x.groupBy("source", "bucket").applyInPandas(
        lambda g: _round_bucket(g, cap),
        "doc_id string, row long, size long, source_size long, target double, copies long")


def row_hash(key: str, source: str, text: str) -> Column:
    return F.xxhash64(F.col(key).cast("string"), F.col(source).cast("string"), F.col(text))


def op7_entropy_mixing(spark, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    got = mix_documents(docs)
    return got.select(F.col("doc_id").cast(docs.schema["doc_id"].dataType).alias("doc_id"), "size", "source_size",
                      "target", (F.col("copies") * F.col("size")).alias("taken"))
