"""Averages that do not depend on the order of the rows."""

import random
from fractions import Fraction

from pyspark.sql import functions as F

from pylonflow.operators.detect import EXACT_METRICS, detect_alerts, exact_avg
from pylonflow.plans import catalog
from tests.conftest import SF001


def test_any_order_and_partitioning_give_the_same_bits(spark):
    rnd = random.Random(4)
    values = [round(rnd.uniform(-1e6, 1e6), rnd.randint(0, 6)) for _ in range(5000)] + [0.1, -0.0, 1e-6]
    want = float(Fraction(sum(round(v * 10**6) for v in values), len(values) * 10**6))
    seen = set()
    for n in (1, 3, 16):
        rnd.shuffle(values)
        df = spark.createDataFrame([(v,) for v in values] + [(None,)], "v double").repartition(n)
        seen.add(df.agg(exact_avg(F.col("v")).alias("a")).first()["a"])
    assert len(seen) == 1 and abs(seen.pop() - want) <= 1e-15 * abs(want)
    empty = spark.createDataFrame([(None,), (None,)], "v double").agg(exact_avg(F.col("v")).alias("a")).first()
    assert empty["a"] is None


def test_stream_equals_batch_in_the_last_bit(spark):
    batch = {(r["tower_id"], r["tower_name"], r["latitude"], r["longitude"], r["window_start"]): (r["avg_temperature"], r["avg_signal"])
             for r in detect_alerts(catalog.telemetry(spark, SF001).repartition(5), metrics=EXACT_METRICS).collect()}
    stream = catalog.q_stream_detect_alerts_exact(spark, SF001).collect()
    assert len(stream) > 50
    for r in stream:
        assert batch[r["tower_id"], r["tower_name"], r["latitude"], r["longitude"], r["window_start"]] == (r["avg_temperature"], r["avg_signal"])
