"""Stream == batch on closed windows, late rows, restart without duplicates,
chained statements, exactly-once model calls."""

import uuid

from pyspark.sql import functions as F

from pylonflow.operators.detect import detect_alerts
from pylonflow.schemas import ALERT
from pylonflow.sources.readings import readings
from pylonflow.sources.tables import read_table
from pylonflow.streaming.flows import Sink, alerts_stream, answer_alerts_once, run_to_sink, start_sink
from tests.conftest import SF01

DELAY = "10 seconds"


def _split_events(spark, scratch):
    ev = read_table(spark, SF01, "events")
    src = f"{scratch}/events"
    ev.filter("event_id < 4000").coalesce(1).write.parquet(src + "/part1")
    return ev, src


def _closed_batch_alerts(spark, ev):
    tel = readings(ev)
    max_t = tel.select(F.max("event_time")).first()[0]
    return detect_alerts(tel).filter(F.col("window_end") <= F.lit(max_t) - F.expr(f"INTERVAL {DELAY}"))


def _keys(df):
    return sorted((r.tower_id, r.tower_name, r.window_start, r.event_count) for r in df.collect())


def test_stream_equals_batch_and_restart_has_no_duplicates(spark, scratch):
    ev, src = _split_events(spark, scratch)
    schema = ev.schema
    sink = Sink(f"{scratch}/alerts", f"{scratch}/ck")
    stream = lambda: alerts_stream(spark.readStream.schema(schema).parquet(src + "/*"), DELAY)
    first = run_to_sink(stream(), sink)
    assert _keys(first) == _keys(_closed_batch_alerts(spark, ev.filter("event_id < 4000")))
    n1 = first.count()
    # idle restart: nothing new, nothing duplicated
    assert run_to_sink(stream(), sink).count() == n1
    # second file arrives: the held-back windows close, no duplicates
    ev.filter("event_id >= 4000").coalesce(1).write.parquet(src + "/part2")
    second = run_to_sink(stream(), sink)
    assert _keys(second) == _keys(_closed_batch_alerts(spark, ev))
    assert second.count() == second.select("tower_id", "tower_name", "window_start").distinct().count()


def test_late_rows_are_dropped_and_counted(spark, scratch):
    ev, src = _split_events(spark, scratch)
    sink = Sink(f"{scratch}/alerts", f"{scratch}/ck")
    schema = ev.schema
    run_to_sink(alerts_stream(spark.readStream.schema(schema).parquet(src + "/*"), DELAY), sink)
    before = _keys(spark.read.parquet(sink.path))
    # breaching readings of the first minutes, far behind the watermark
    ev.orderBy("event_id").filter("value > 300").limit(3).coalesce(1).write.parquet(src + "/late")
    q = start_sink(alerts_stream(spark.readStream.schema(schema).parquet(src + "/*"), DELAY), sink)
    q.awaitTermination()
    from pylonflow.streaming.flows import late_groups_dropped
    assert late_groups_dropped(q) >= 1
    assert _keys(spark.read.parquet(sink.path)) == before


def test_responder_calls_once_per_alert(spark, scratch):
    from pylonflow.plans import catalog
    batch = catalog.alerts(spark, SF01)
    path = f"{scratch}/responses"
    body = answer_alerts_once(path)
    body(batch, 0)
    n = spark.read.parquet(path).count()
    assert n == catalog.q_generate_runbooks(spark, SF01).count() > 0
    body(batch, 0)  # replayed micro-batch
    assert spark.read.parquet(path).count() == n


def test_chain_through_durable_table(spark):
    from pylonflow.plans import catalog
    out = catalog.q_stream_chain(spark, SF01)
    assert out.count() == out.select("tower_id", "tower_name", "window_start").distinct().count() > 0


def test_partition_by_key_colocates(spark):
    from pylonflow.streaming.flows import partition_by_key
    from pylonflow.plans import catalog
    df = partition_by_key(catalog.telemetry(spark, SF01), 3)
    per_part = df.select("tower_id", F.spark_partition_id().alias("p")).distinct()
    assert df.rdd.getNumPartitions() == 3
    assert per_part.count() == per_part.select("tower_id").distinct().count() == 16


def test_live_status_turns_red_immediately_and_green_on_expiry(spark, scratch):
    from datetime import datetime, timedelta

    from pylonflow.streaming.status import status_changes_stream
    t0 = datetime(2024, 1, 1, 0, 1)
    src = f"{scratch}/alerts_in"
    schema = "tower_id string, window_end timestamp"
    spark.createDataFrame([("A", t0), ("A", t0 + timedelta(seconds=60))], schema).write.parquet(src + "/b1")
    sink = Sink(f"{scratch}/changes", f"{scratch}/ck")
    stream = lambda: status_changes_stream(spark.readStream.schema(schema).parquet(src + "/*"))
    first = sorted((r.changed_at, r.status) for r in run_to_sink(stream(), sink).collect())
    assert first == [(t0, "red")]  # red now, while the episode is still open
    spark.createDataFrame([("A", t0 + timedelta(seconds=1000)), ("B", t0 + timedelta(seconds=2000))],
                          schema).write.parquet(src + "/b2")
    second = sorted((r.tower_id, r.changed_at, r.status) for r in run_to_sink(stream(), sink).collect())
    assert ("A", t0 + timedelta(seconds=150), "green") in second          # gap seen in data
    assert ("A", t0 + timedelta(seconds=1000), "red") in second
    assert ("A", t0 + timedelta(seconds=1090), "green") in second         # watermark passed expiry
    assert ("B", t0 + timedelta(seconds=2000), "red") in second
    assert len(second) == len(set(second))


def test_sentinel_closes_every_window(spark, scratch):
    ev = read_table(spark, SF01, "events")
    src = f"{scratch}/events"
    ev.coalesce(1).write.parquet(src + "/all")
    # a normal reading far after the last one advances the watermark past every window
    (ev.limit(1).withColumns({"ts": F.lit("2024-06-01").cast("timestamp"), "value": F.lit(1.0), "props": F.lit('{"k": 1}')})
     .write.parquet(src + "/sentinel"))
    out = run_to_sink(alerts_stream(spark.readStream.schema(ev.schema).parquet(src + "/*"), DELAY),
                      Sink(f"{scratch}/alerts", f"{scratch}/ck"))
    assert _keys(out) == _keys(detect_alerts(readings(ev)))


def test_max_files_per_trigger_paces_input(spark, scratch):
    ev = read_table(spark, SF01, "events")
    src = f"{scratch}/events"
    for i in range(3):
        ev.filter(F.col("event_id") % 3 == i).coalesce(1).write.parquet(f"{src}/p{i}")
    reader = spark.readStream.schema(ev.schema).option("maxFilesPerTrigger", "1").parquet(src + "/*")
    q = start_sink(reader, Sink(f"{scratch}/out", f"{scratch}/ck"))
    q.awaitTermination()
    assert sum(1 for p in q.recentProgress if p["numInputRows"] > 0) == 3


def test_file_topic_roundtrip_keyed(spark, scratch):
    from pylonflow.plans import catalog
    from pylonflow.schemas import ALERT
    from pylonflow.streaming.topics import Topic, consumer_checkpoint, read_topic, write_topic
    topic = Topic("anomaly-alerts", ALERT, path=f"{scratch}/topic")
    src = f"{scratch}/events"
    ev = read_table(spark, SF01, "events")
    ev.coalesce(1).write.parquet(src)
    q = write_topic(alerts_stream(spark.readStream.schema(ev.schema).parquet(src), DELAY), topic,
                    f"{scratch}/ck", available_now=True, keyed_partitions=True)
    q.awaitTermination()
    back = read_topic(spark, topic, streaming=False)
    assert back.columns == ["key"] + ALERT.fieldNames()  # 12 columns, key first
    assert back.filter(F.col("key").cast("string") != F.col("tower_id")).count() == 0
    assert back.count() == catalog.q_stream_detect_alerts(spark, SF01).count()
    dash = f"dash-{uuid.uuid4().hex}"     # the checkpoint root may outlive a test run
    ck, start = consumer_checkpoint(spark, dash, "resume")
    assert start == "earliest" and ck == consumer_checkpoint(spark, dash, "resume")[0]
    ck2, start2 = consumer_checkpoint(spark, dash, "skip")
    assert start2 == "latest" and ck2 != ck
    assert consumer_checkpoint(spark, dash, "resume") == (ck2, "latest")   # what was skipped stays skipped
    assert consumer_checkpoint(spark, dash, "skip")[0] not in (ck, ck2)


def test_stateful_twins_on_rocksdb_state_store(spark):
    import __spark_entry__ as entry
    from tests.oracle_compare import duck, fingerprint
    key = "spark.sql.streaming.stateStore.providerClass"
    old = spark.conf.get(key)
    spark.conf.set(key, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        con = duck(SF01)
        for name in ("stream_detect_alerts", "stream_status_changes"):
            a = fingerprint(entry.queries()[name](spark, SF01).toPandas())
            b = fingerprint(con.execute(entry.oracle_sql()[name]).df())
            assert a[:3] == b[:3], name
    finally:
        spark.conf.set(key, old)


def test_live_status_survives_out_of_order_alerts_and_non_utc_zone(spark, scratch):
    from datetime import datetime, timedelta, timezone

    from pylonflow.streaming.status import status_changes_stream
    t0 = datetime(2024, 1, 1, 0, 1, tzinfo=timezone.utc)
    schema = "tower_id string, window_end timestamp"
    src = f"{scratch}/alerts_in"
    for i, (k, m) in enumerate([("A", 0), ("B", 10), ("X", 5)]):   # X arrives after the watermark jumped
        spark.createDataFrame([(k, t0 + timedelta(minutes=m))], schema).coalesce(1).write.parquet(f"{src}/b{i}")
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", "1").parquet(src + "/*")
        out = run_to_sink(status_changes_stream(stream), Sink(f"{scratch}/out", f"{scratch}/ck"))
        got = {(r.tower_id, r.status): r.changed_at.replace(tzinfo=None) for r in out.collect()}
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert ("X", "red") in got and ("X", "green") in got          # green emitted at once, no invalid timer
    assert ("A", "green") in got and ("B", "red") in got
    assert len(got) == 5
