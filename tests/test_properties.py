"""Properties taken from the producer's value ranges: normal readings never
alert, anomalous ones always do; alert invariants hold."""

from datetime import datetime, timedelta

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pylonflow import TELEMETRY, anomaly_filter, detect_alerts, escalation_filter
from pylonflow.schemas import ALERT

T0 = datetime(2024, 7, 15, 10, 0)
normal = st.tuples(st.floats(60, 84), st.floats(-89, -65), st.just(False))
anomalous = st.tuples(st.floats(88, 95, exclude_max=True), st.floats(-100, -91), st.just(True))
reading = st.tuples(st.sampled_from(["TWR-001", "TWR-002", "TWR-004"]), st.one_of(normal, anomalous),
                    st.integers(0, 600_000))


def _frame(spark, rows):
    data = [(tid, tid.lower(), 40.0, -3.0, v[0], v[1], 50.0, T0 + timedelta(milliseconds=ms), v[2])
            for tid, v, ms in rows]
    return spark.createDataFrame(data, TELEMETRY)


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(reading, min_size=1, max_size=80))
def test_alert_invariants(spark, rows):
    df = _frame(spark, rows)
    passed = anomaly_filter(df)
    # anomalous readings always pass, normal ones never do
    assert passed.filter(~F.col("is_anomaly")).count() == 0
    assert passed.count() == sum(1 for _, v, _ in rows if v[2])
    alerts = detect_alerts(df).cache()
    n_alerts = alerts.count()
    if n_alerts:
        s = alerts.agg(F.sum("event_count")).first()[0]
        assert s == passed.count()
        bad = alerts.filter((F.col("max_temperature") < F.col("avg_temperature") - 1e-9)
                            | (F.col("min_signal") > F.col("avg_signal") + 1e-9)
                            | (F.col("window_end") != F.col("window_start") + F.expr("INTERVAL 60 seconds")))
        assert bad.count() == 0
        assert alerts.select("tower_id", "window_start").distinct().count() == n_alerts
        esc = escalation_filter(alerts)
        assert esc.join(alerts, ["tower_id", "window_start"], "left_anti").count() == 0
        assert alerts.schema.fieldNames() == ALERT.fieldNames()
    alerts.unpersist()
