"""The wiring facade: batch transforms equal the registered queries, and the
four streaming queries produce the same tables as their batch twins."""

from pyspark.sql import functions as F

from pylonflow.plans import catalog
from pylonflow.plans.dataflow import AlertingDataflow
from pylonflow.sources.tables import stream_table
from pylonflow.sources.readings import readings
from tests.conftest import SF001


def _rows(df, cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_batch_facade(spark):
    flow = AlertingDataflow()
    tel = catalog.telemetry(spark, SF001)
    alerts = flow.alerts(tel)
    assert alerts.count() == catalog.q_detect_alerts_60s(spark, SF001).count() > 50
    rb = flow.runbooks(alerts)
    assert rb.count() == catalog.q_generate_runbooks(spark, SF001).count() > 0
    assert rb.filter(F.col("severity_level").isNull()).count() == 0
    assert flow.episodes(alerts).count() == catalog.q_red_episodes(spark, SF001).count() > 0
    assert flow.latest(tel).count() == tel.select("tower_id").distinct().count()


def test_streaming_facade(spark):
    flow = AlertingDataflow()
    tel_stream = readings(stream_table(spark, SF001, "events"))
    h = flow.start(spark, tel_stream, available_now=True)
    for q in h.queries():
        q.awaitTermination()
    resp = spark.read.parquet(h.responses_path)
    runbooks = spark.read.parquet(h.runbooks_path)
    assert runbooks.count() == resp.count() and runbooks.filter("severity_level IS NULL").count() == 0
    closed = spark.read.parquet(h.alerts_path)
    assert resp.count() == catalog.generate_runbooks(closed).count() > 0
    batch_latest = catalog.q_latest_by_tower(spark, SF001)
    cols = ["tower_id", "temperature", "last_updated"]
    assert _rows(flow.read_latest(spark, h), cols) == _rows(batch_latest, cols)
    as_of = closed.select(F.max("window_end")).scalar()
    st = flow.read_status(spark, h, as_of)
    assert st.count() == batch_latest.count() and st.filter("status = 'red'").count() >= 1
    explicit = flow.read_status(spark, h, as_of, towers=catalog.telemetry(spark, SF001))
    assert sorted(map(tuple, st.collect())) == sorted(map(tuple, explicit.collect()))


def test_custom_config_matches_brute_force(spark):
    from pylonflow.plans.dataflow import AlertingConfig
    from pylonflow.sources.tables import read_table
    cfg = AlertingConfig(rules=(("value", ">", 150.0), ("value", "<", 1.0)), window="5 minutes", keys=("user_id",),
                         metrics=(("peak", "max", "value"), ("low", "min", "value")), time_col="ts",
                         status_ttl="10 minutes", episode_bucket="1 hour")
    flow = AlertingDataflow(cfg)
    ev = read_table(spark, "/root/testdata/sf0.01", "events")
    got = flow.alerts(ev).toPandas()
    pdf = ev.select("user_id", "ts", "value").toPandas()
    hit = pdf[(pdf.value > 150.0) | (pdf.value < 1.0)].copy()
    hit["window_start"] = hit.ts.dt.floor("5min")
    exp = hit.groupby(["user_id", "window_start"]).agg(peak=("value", "max"), low=("value", "min"),
                                                      event_count=("value", "size")).reset_index()
    m = got.merge(exp, on=["user_id", "window_start"], suffixes=("", "_x"))
    assert len(got) == len(exp) == len(m)
    assert (m.peak == m.peak_x).all() and (m.low == m.low_x).all() and (m.event_count == m.event_count_x).all()
    eps = flow.episodes(flow.alerts(ev))
    assert eps.agg(F.sum("alert_count")).first()[0] == len(exp)


def test_streaming_with_custom_keys_and_historical_status(spark):
    from datetime import timedelta

    from pylonflow.plans.dataflow import AlertingConfig
    cfg = AlertingConfig(rules=(("value", ">", 150.0),), window="5 minutes", keys=("user_id",),
                         metrics=(("peak", "max", "value"),), time_col="ts",
                         latest_values=("event_type", "value"))
    flow = AlertingDataflow(cfg)
    ev = stream_table(spark, "/root/testdata/sf0.01", "events")
    h = flow.start(spark, ev, available_now=True)
    for q in h.queries():
        q.awaitTermination()
    assert h.responder is None and h.runbooks is None      # runbooks need the tower alert record
    alerts = spark.read.parquet(h.alerts_path)
    assert "peak" in alerts.columns and alerts.count() > 0
    assert flow.read_latest(spark, h).count() == 150
    # status at a past instant: exact from the alerts table, not only the newest alert
    one = alerts.orderBy("window_end").first()
    as_of = one.window_end + timedelta(seconds=30)
    st = {r.user_id: r for r in flow.read_status(spark, h, as_of).collect()}
    assert st[one.user_id].status == "red" and st[one.user_id].last_alert == one.window_end
