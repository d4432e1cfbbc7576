"""Model-call operator: retries, errors, pacing, callers, plan order."""

import re
import time

import pytest
from pyspark.sql import functions as F

from pylonflow.operators.infer import CallOptions, ModelCallError, ModelSpec, _call_with_retry, predict, rule_model
from pylonflow.operators.runbook import generate_runbooks
from pylonflow.plans import catalog
from tests.conftest import SF001


def test_retry_then_success_with_backoff():
    calls, sleeps = [], []

    def flaky(s, p, params):
        calls.append(p)
        if len(calls) < 3:
            raise TimeoutError("429")
        return "ok"

    out = _call_with_retry(flaky, "sys", "p", {}, CallOptions(retry_count=3, backoff_s=0.5), sleep=sleeps.append)
    assert out == "ok" and len(calls) == 3 and sleeps == [0.5, 1.0]


def test_retry_exhausted_raises():
    def bad(s, p, params):
        raise TimeoutError("down")

    with pytest.raises(ModelCallError):
        _call_with_retry(bad, "sys", "p", {}, CallOptions(retry_count=2, backoff_s=0), sleep=lambda s: None)


def test_error_column_and_null_prompt(spark):
    def bad(s, p, params):
        raise RuntimeError("nope")

    df = spark.createDataFrame([("a",), (None,)], "prompt string")
    out = predict(df, bad, options=CallOptions(retry_count=1, backoff_s=0), on_error="column").collect()
    assert len(out) == 1  # NULL prompt -> no row (inner lateral semantics)
    assert out[0].response is None and "nope" in out[0].response_error


def test_params_reach_the_callable(spark):
    def echo(s, p, params):
        return f"{s}|{p}|{params['temperature']}|{params['max_tokens']}|{params['client_timeout']}"

    df = spark.createDataFrame([("x",)], "prompt string")
    r = predict(df, echo, ModelSpec(system_prompt="S"), options=CallOptions(client_timeout=7)).first()
    assert r.response == "S|x|0.1|1024|7"


def test_pacing_per_caller(spark):
    df = spark.range(5).select(F.col("id").cast("string").alias("prompt")).coalesce(1)
    out = predict(df, lambda s, p, params: repr(time.monotonic()),
                  options=CallOptions(calls_per_minute=600)).collect()
    ts = sorted(float(r.response) for r in out)
    assert all(b - a >= 0.07 for a, b in zip(ts, ts[1:]))


def test_n_callers_repartitions(spark):
    df = spark.range(20).select(F.col("id").cast("string").alias("prompt"))
    out = predict(df, lambda s, p, params: p, n_callers=3)
    assert out.rdd.getNumPartitions() == 3
    assert sorted(int(r.response) for r in out.collect()) == list(range(20))


def test_escalation_filter_runs_before_the_model_call(spark):
    plan = generate_runbooks(catalog.alerts(spark, SF001))._jdf.queryExecution().executedPlan().toString()
    i_map = plan.index("MapInPandas")
    i_filter = re.search(r"avg_temperature#\d+ > 88\.0", plan).start()
    assert i_filter > i_map, "escalation filter must sit below (run before) the Python call"


def test_rule_model_grades():
    p = "Tower:TWR-002 Salamanca\nAvgTemp:91.5C MaxTemp:93.1C\nAvgSig:-95.2dBm MinSig:-98.4dBm\nEvents:4"
    assert rule_model("", p, {}).startswith("SEVERITY: CRITICAL\nDIAGNOSIS: average 91.5C over limit\nACTION1: check TWR-002")
    assert rule_model("", p.replace("91.5", "87.9"), {}).endswith("TICKET: P4")


def test_sql_lateral_model_call(spark):
    from pylonflow.operators.sql_surface import register_predict_udtf
    register_predict_udtf(spark, rule_model)
    catalog.alerts(spark, SF001).createOrReplaceTempView("alerts_sql_test")
    q = spark.sql("""
        SELECT a.tower_id, p.response
        FROM (SELECT *, concat('Tower:', tower_id, ' ', tower_name, '\\n', 'AvgTemp:',
                               cast(round(avg_temperature, 1) AS string), 'C') AS prompt
              FROM alerts_sql_test WHERE avg_temperature > 88.0 OR avg_signal < -93.0) a,
             LATERAL ml_predict(a.prompt) p""")
    rows = q.collect()
    assert len(rows) == catalog.q_escalated_alerts(spark, SF001).filter("avg_temperature IS NOT NULL").count()
    assert all(r.response.startswith("SEVERITY: ") and f"check {r.tower_id}" in r.response for r in rows)


def test_processed_at_is_one_value_per_query(spark):
    out = generate_runbooks(catalog.alerts(spark, SF001))
    assert out.select("processed_at").distinct().count() == 1


def test_total_budget_is_split_over_callers(spark):
    df = spark.range(6).select(F.col("id").cast("string").alias("prompt"))
    out = predict(df, lambda s, p, params: repr(time.monotonic()), n_callers=2,
                  options=CallOptions(total_calls_per_minute=600)).select(
        F.spark_partition_id().alias("part"), "response").collect()
    by_part = {}
    for r in out:
        by_part.setdefault(r.part, []).append(float(r.response))
    assert len(by_part) == 2
    for ts in by_part.values():           # 600/min over 2 callers -> 0.2 s apart per caller, less a thread's start
        ts.sort()
        assert all(b - a >= 0.15 for a, b in zip(ts, ts[1:]))
    with pytest.raises(ValueError):
        predict(df, rule_model, options=CallOptions(total_calls_per_minute=30))


def test_processed_at_has_millisecond_precision(spark):
    out = generate_runbooks(catalog.alerts(spark, SF001)).select("processed_at").first()[0]
    assert out.microsecond % 1000 == 0


def test_async_calls_overlap_and_keep_row_order(spark):
    def slow(s, p, params):
        time.sleep(0.3)
        return f"{p}:{time.monotonic()}"

    df = spark.range(8).select(F.col("id").cast("string").alias("prompt")).coalesce(1)
    t0 = time.perf_counter()
    out = predict(df, slow, options=CallOptions(async_enabled=True, max_in_flight=4)).collect()
    assert [r.response.split(":")[0] for r in out] == [r.prompt for r in out]
    assert sorted(int(r.prompt) for r in out) == list(range(8))
    starts = sorted(float(r.response.split(":")[1]) for r in out)
    assert starts[-1] - starts[0] < 0.3 * 8 * 0.75          # overlapped, not 8 serial calls
    assert time.perf_counter() - t0 < 30


def test_breach_flags_unique_names_per_rule(spark):
    from pylonflow.operators.filters import breach_flags
    df = spark.createDataFrame([(90.0,), (-20.0,), (20.0,)], "temperature double")
    out = breach_flags(df, rules=(("temperature", ">", 85.0), ("temperature", "<", -10.0)))
    cols = [c for c in out.columns if c.endswith("_breach")]
    assert len(cols) == 3 and "any_breach" in cols
    assert [r.any_breach for r in out.collect()] == [True, True, False]


def test_sql_statement_uses_the_configured_output_column(spark):
    from pylonflow.plans.sql import generate_runbooks_sql
    out = generate_runbooks_sql(spark, SF001, model=ModelSpec(output_col="answer"))
    n = catalog.q_generate_runbooks(spark, SF001).count()
    assert out.filter("agent_response LIKE 'SEVERITY:%'").count() == out.count() == n > 0


def test_a_hanging_call_times_out_and_is_retried(spark):
    def hang(s, p, params):
        if p == "1":
            time.sleep(60)
        return "ok"

    df = spark.range(3).select(F.col("id").cast("string").alias("prompt")).coalesce(1)
    began = time.perf_counter()
    out = predict(df, hang, options=CallOptions(client_timeout=0.3, retry_count=1, backoff_s=0.05), on_error="column").collect()
    got = {r.prompt: (r.response, r.response_error) for r in out}
    assert got["0"] == got["2"] == ("ok", None) and got["1"][0] is None and "no answer within 0.3 s" in got["1"][1]
    assert time.perf_counter() - began < 40


def test_a_fresh_worker_waits_a_gap_before_its_first_call(monkeypatch):
    from pylonflow.operators import infer
    for _ in range(2):   # two workers that know of no earlier call
        monkeypatch.setattr(infer, "_LAST_CALL", {})
        began = time.monotonic()
        infer._Pacer("k", 0.2).wait()
        assert time.monotonic() - began >= 0.19


def test_one_bad_prompt_does_not_stop_the_others(spark):
    def picky(s, p, params):
        if p.startswith("Tower:T03"):
            raise RuntimeError("refused")
        return rule_model(s, p, params)

    alerts = catalog.alerts(spark, SF001)
    out = generate_runbooks(alerts, picky, options=CallOptions(retry_count=0), on_error="column")
    bad = out.filter("response_error IS NOT NULL")
    assert bad.count() == out.filter("tower_id = 'T03'").count() > 0 and out.filter("agent_response = ''").count() == bad.count()
    assert out.count() == catalog.q_generate_runbooks(spark, SF001).count()
