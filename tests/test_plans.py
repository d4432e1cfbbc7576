"""Physical-plan checks: pushdown, pruning, partial aggregation, no cross
joins anywhere, no Python in the JVM-only operators."""

import pytest

import __spark_entry__ as entry
from pylonflow.operators.detect import detect_alerts
from pylonflow.operators.filters import anomaly_filter
from pylonflow.plans import catalog
from tests.conftest import SF001

BATCH = sorted(n for n in entry.queries() if not n.startswith("stream_"))


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def tel_parquet(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tel") / "telemetry")
    catalog.telemetry(spark, SF001).write.parquet(path)
    return path


def test_anomaly_filter_pushed_into_scan(spark, tel_parquet):
    p = plan_of(anomaly_filter(spark.read.parquet(tel_parquet)))
    assert "PushedFilters: [Or(GreaterThan(temperature,85.0),LessThan(signal_strength,-90.0))]" in p


def test_detect_prunes_columns_and_aggregates_partially(spark, tel_parquet):
    p = plan_of(detect_alerts(spark.read.parquet(tel_parquet)))
    read_schema = p[p.index("ReadSchema"):].split("\n")[0]
    assert "cpu_load" not in read_schema and "is_anomaly" not in read_schema
    assert "partial_avg" in p and "partial_count" in p


@pytest.mark.parametrize("name", BATCH)
def test_no_cross_join_or_row_udf(spark, name):
    p = plan_of(entry.queries()[name](spark, SF001))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython"):
        assert bad not in p, f"{name} plans a {bad}"


@pytest.mark.parametrize("name", ["latest_by_tower", "latest_by_user_raw_events", "tower_status"])
def test_views_pre_aggregate_before_shuffle(spark, name):
    p = plan_of(entry.queries()[name](spark, SF001))
    assert "partial_max" in p


def final_plan(df) -> str:
    df.collect()
    ep = df._jdf.queryExecution().executedPlan()
    return ep.finalPhysicalPlan().toString() if hasattr(ep, "finalPhysicalPlan") else ep.toString()


def test_episodes_consume_input_once_and_window_by_bucket(spark):
    """One scan of the input; the row-level window is partitioned by
    (key, bucket); per-key windows only see candidate rows."""
    p = final_plan(catalog.q_red_episodes(spark, SF001))
    assert p.count("FileScan") == 1
    assert "Join" not in p
    assert "hashpartitioning(tower_id#" in p and "_b#" in p


def test_only_model_call_uses_python(spark):
    for name in BATCH:
        p = plan_of(entry.queries()[name](spark, SF001))
        uses_python = "MapInPandas" in p or "ArrowEvalPython" in p
        assert uses_python == (name in {"generate_runbooks", "parse_runbook", "enrich_if_absent",
                                        "severity_default", "runbook_feed", "sql_generate_runbooks"}), name
