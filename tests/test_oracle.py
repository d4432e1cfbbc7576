"""Every registered query against its DuckDB twin at sf0.01 (the driver's gate)."""

import pytest

import __spark_entry__ as entry
from pylonflow.plans.catalog import QUERIES
from tests.conftest import SF001, SF01
from tests.oracle_compare import duck, fingerprint

CORE = {**QUERIES}
NAMES = sorted(CORE)


def test_every_query_has_an_oracle_or_is_listed():
    missing = set(entry.queries()) - set(entry.oracle_sql())
    assert not missing & set(CORE), f"queries without SQL twin: {missing}"


@pytest.fixture(scope="module")
def con():
    return duck(SF01)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    sp = entry.queries()[name](spark, SF01).toPandas()
    dk = con.execute(entry.oracle_sql()[name]).df()
    a, b = fingerprint(sp), fingerprint(dk)
    assert a[1] == b[1], "column names differ"
    assert a[0] == b[0], "row counts differ"
    assert a[2] == b[2], f"values differ: {sorted(set(a[3]) ^ set(b[3]))[:4]}"


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert len(df.collect()) > 50
    assert df.columns == ["tower_id", "tower_name", "latitude", "longitude", "avg_temperature", "avg_signal",
                          "max_temperature", "min_signal", "event_count", "window_start", "window_end"]


def test_readings_have_nulls_ties_and_a_hot_tower(spark):
    from pyspark.sql import functions as F

    from pylonflow.plans import catalog as c
    tel = c.telemetry(spark, "/root/testdata/sf0.1")
    n = tel.count()
    assert tel.filter("temperature IS NULL").count() > n // 10
    assert tel.groupBy("tower_id").count().agg(F.max("count")).first()[0] > n // 2
    assert tel.select("tower_id", "event_time").distinct().count() < n
    alerts = c.alerts(spark, SF001)
    assert alerts.groupBy("tower_id", "window_start").count().filter("count > 1").count() > 0   # several names in one window
    assert alerts.agg(F.sum("event_count")).first()[0] == c.q_anomaly_filter(spark, SF001).count()
