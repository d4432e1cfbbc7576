"""Edge cases: thresholds, window boundaries, NULLs, runbook parser rules,
enrichment, decoding, golden records from the documentation."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pylonflow import (
    ALERT, RESPONSE, TELEMETRY, anomaly_filter, breach_flags, build_prompt, conform, decode_envelope,
    detect_alerts, enrich_if_absent, escalation_filter, parse_runbook, retain, severity_default,
)
from pylonflow.schemas import PARSED_FIELDS, SchemaMismatch

TS = datetime(2024, 7, 15, 10, 24, 0)


def _tel(spark, rows):
    full = [("TWR-002", "Salamanca", 40.4308, -3.68, t, s, 50.0, ts, False) for t, s, ts in rows]
    return spark.createDataFrame(full, _nullable(TELEMETRY))


def _nullable(schema):
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in schema.fields])


def test_thresholds_are_strict(spark):
    rows = [(85.0, -80.0, TS), (85.0001, -80.0, TS), (60.0, -90.0, TS), (60.0, -90.0001, TS), (None, -95.0, TS),
            (None, None, TS)]
    got = anomaly_filter(_tel(spark, rows)).select("temperature", "signal_strength").collect()
    assert [(r[0], r[1]) for r in got] == [(85.0001, -80.0), (60.0, -90.0001), (None, -95.0)]


def test_breach_flags_three_valued(spark):
    rows = [(90.0, None, TS), (None, None, TS), (60.0, -70.0, TS)]
    got = breach_flags(_tel(spark, rows)).select("temperature_breach", "signal_breach", "any_breach").collect()
    assert [tuple(r) for r in got] == [(True, None, True), (None, None, None), (False, False, False)]


def test_escalation_thresholds_are_strict(spark):
    base = dict(tower_id="T", tower_name="n", latitude=0.0, longitude=0.0, max_temperature=0.0, min_signal=0.0,
                event_count=1, window_start=TS, window_end=TS)
    rows = [dict(base, avg_temperature=88.0, avg_signal=-93.0), dict(base, avg_temperature=88.01, avg_signal=-80.0),
            dict(base, avg_temperature=80.0, avg_signal=-93.01)]
    df = spark.createDataFrame(rows, _nullable(ALERT))
    assert sorted(r.avg_temperature for r in escalation_filter(df).collect()) == [80.0, 88.01]


def test_window_boundaries(spark):
    # a reading exactly at window_end belongs to the next window
    rows = [(90.0, -95.0, datetime(2024, 1, 1, 0, 0, 59, 999000)), (91.0, -95.0, datetime(2024, 1, 1, 0, 1, 0))]
    got = detect_alerts(_tel(spark, rows)).orderBy("window_start").collect()
    assert [(r.window_start, r.window_end, r.event_count) for r in got] == [
        (datetime(2024, 1, 1, 0, 0), datetime(2024, 1, 1, 0, 1), 1),
        (datetime(2024, 1, 1, 0, 1), datetime(2024, 1, 1, 0, 2), 1)]


def test_alert_aggregates_and_nulls(spark):
    rows = [(90.0, -95.0, TS), (92.0, None, TS), (70.0, -99.0, TS), (70.0, -80.0, TS)]
    r = detect_alerts(_tel(spark, rows)).collect()
    assert len(r) == 1
    r = r[0]
    assert r.event_count == 3
    assert r.avg_temperature == pytest.approx((90 + 92 + 70) / 3)
    assert r.avg_signal == pytest.approx((-95 - 99) / 2)  # AVG skips NULL
    assert (r.max_temperature, r.min_signal) == (92.0, -99.0)
    assert r.window_end - r.window_start == (datetime(2024, 1, 1, 0, 1) - datetime(2024, 1, 1, 0, 0))


def test_changed_attribute_splits_group(spark):
    rows = [("TWR-002", "Salamanca", 40.0, -3.0, 90.0, -95.0, 1.0, TS, True),
            ("TWR-002", "Salamanca2", 40.0, -3.0, 90.0, -95.0, 1.0, TS, True)]
    df = spark.createDataFrame(rows, _nullable(TELEMETRY))
    assert detect_alerts(df).count() == 2


def test_golden_prompt(spark):
    # documented alert record and the prompt the statement builds from it
    alert = [("TWR-002", "Salamanca", 40.4308, -3.68, 90.7, -95.2, 93.1, -98.4, 4,
              datetime(2024, 7, 15, 10, 24), datetime(2024, 7, 15, 10, 25))]  # 1721039040000 .. 1721039100000 ms
    df = spark.createDataFrame(alert, _nullable(ALERT))
    assert escalation_filter(df).count() == 1
    p = build_prompt(df).first().prompt
    assert p == "Tower:TWR-002 Salamanca\nAvgTemp:90.7C MaxTemp:93.1C\nAvgSig:-95.2dBm MinSig:-98.4dBm\nEvents:4"


def test_prompt_rounding_half_up_and_null(spark):
    alert = [("T", "n", 0.0, 0.0, 90.25, -95.25, 90.0, -98.0, 1, TS, TS), ("T", None, 0.0, 0.0, 1.0, 1.0, 1.0, 1.0, 1, TS, TS)]
    rows = build_prompt(spark.createDataFrame(alert, _nullable(ALERT))).select("prompt").collect()
    assert "AvgTemp:90.3C MaxTemp:90.0C" in rows[0].prompt and "AvgSig:-95.3dBm" in rows[0].prompt
    assert rows[1].prompt is None  # CONCAT propagates NULL


GOLDEN_TEXT = ("SEVERITY: CRITICAL\nDIAGNOSIS: Cooling fan failure causing thermal overload\n"
               "ACTION1: Check cooling system via SSH\nACTION2: Reduce TX power by 3 dB\n"
               "ACTION3: Dispatch field engineer\nESCALATION: RF team if temp exceeds 95C\nTICKET: P1")

PARSE_CASES = [
    (None, (None, None, None, None, None)),
    ("", (None, None, None, None, None)),
    ("  severity: critical\nDIAGNOSIS: fan\n\nACTION2: b\nACTION1: a \r\nESCALATION:\nTICKET: p1\nSEVERITY:",
     ("CRITICAL", "fan", "1. b\n2. a", None, "P1")),
    ("SEVERITY: low\nSEVERITY: high", ("HIGH", None, None, None, None)),
    ("SEVERITY: banana", ("BANANA", None, None, None, None)),
    ("see SEVERITY: HIGH", (None, None, None, None, None)),
    (GOLDEN_TEXT, ("CRITICAL", "Cooling fan failure causing thermal overload",
                   "1. Check cooling system via SSH\n2. Reduce TX power by 3 dB\n3. Dispatch field engineer",
                   "RF team if temp exceeds 95C", "P1")),
    ("\ufeff\u00a0 DIAGNOSIS:\u3000hot\u2029\nnotes without label\nACTION7:   x  ", (None, "hot", "1. x", None, None)),
    ("diagnosis: first\nDiagnosis: second", (None, "second", None, None, None)),
]


@pytest.mark.parametrize("text,expected", PARSE_CASES)
def test_parse_runbook_rules(spark, text, expected):
    df = spark.createDataFrame([(text,)], "agent_response string")
    r = parse_runbook(df).first()
    assert tuple(r[f] for f in PARSED_FIELDS) == expected


def test_parse_runbook_has_no_python_node(spark):
    df = spark.createDataFrame([(GOLDEN_TEXT,)], "agent_response string")
    plan = parse_runbook(df)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "ArrowEval" not in plan and "BatchEval" not in plan


def test_enrich_if_absent_cases(spark):
    schema = "severity_level string, diagnosis string, immediate_actions string, escalation string, " \
             "ticket_priority string, agent_response string, id int"
    rows = [("LOW", "old", None, None, None, GOLDEN_TEXT, 1),   # severity set -> unchanged
            (None, "old", None, None, None, GOLDEN_TEXT, 2),    # absent -> all five replaced
            ("", "old", "x", "y", "z", "SEVERITY: low", 3),      # '' counts as absent; NULLs overwrite
            (None, "old", None, None, None, None, 4),           # no text -> unchanged
            (None, "old", None, None, None, "", 5)]             # '' text -> unchanged
    out = {r.id: r for r in enrich_if_absent(spark.createDataFrame(rows, schema)).collect()}
    assert (out[1].severity_level, out[1].diagnosis) == ("LOW", "old")
    assert (out[2].severity_level, out[2].ticket_priority) == ("CRITICAL", "P1")
    assert out[2].diagnosis == "Cooling fan failure causing thermal overload"
    assert (out[3].severity_level, out[3].diagnosis, out[3].immediate_actions, out[3].escalation,
            out[3].ticket_priority) == ("LOW", None, None, None, None)
    assert (out[4].severity_level, out[4].diagnosis) == (None, "old")
    assert (out[5].severity_level, out[5].diagnosis) == (None, "old")
    labels = {r.id: r.severity_label for r in severity_default(enrich_if_absent(spark.createDataFrame(rows, schema))).collect()}
    assert labels == {1: "LOW", 2: "CRITICAL", 3: "LOW", 4: "unknown", 5: "unknown"}


def test_decode_envelope_cases(spark):
    schema = T.StructType([T.StructField("tower_id", T.StringType()), T.StructField("temperature", T.DoubleType())])
    vals = [b'{"tower_id":"TWR-002","temperature":91.4}', None, b"", b"null", b"bad", b"\x00\x00\x00\x00\x01ab",
            b'{"tower_id":"TWR-003"}', b"[1,2]"]
    env = spark.createDataFrame([(b"k", v) for v in vals], "key binary, value binary")
    good, bad = decode_envelope(env, schema, with_rejected=True)
    got = sorted((r.tower_id, r.temperature) for r in good.collect())
    assert got == [("TWR-002", 91.4), ("TWR-003", None)]
    assert good.count() + bad.count() == len(vals)


def test_decode_avro_requires_package(spark):
    env = spark.createDataFrame([(b"k", b"\x00")], "key binary, value binary")
    with pytest.raises(RuntimeError, match="spark-avro"):
        decode_envelope(env, T.StructType([T.StructField("a", T.StringType())]), avro_schema='"string"')


def test_conform_contract(spark):
    df = spark.createDataFrame([("T", 1.0, 2.0, 3.0, 4.0, 5, TS, TS)],
                               "tower_id string, avg_temperature double, avg_signal double, max_temperature double, "
                               "min_signal double, event_count int, window_start timestamp, window_end timestamp")
    out = conform(df, ALERT, key="tower_id")
    assert out.columns == ["key"] + [f.name for f in ALERT.fields] and len(out.columns) == 12
    r = out.first()
    assert (bytes(r.key), r.tower_name, r.latitude, r.longitude) == (b"T", "", 0.0, 0.0)
    assert dict(out.dtypes)["event_count"] == "bigint"
    with pytest.raises(SchemaMismatch):
        conform(df.drop("avg_signal"), ALERT)
    with pytest.raises(SchemaMismatch):
        conform(df.withColumn("extra", F.lit(1)), ALERT)
    resp = conform(df.withColumn("agent_response", F.lit("x")).withColumn("processed_at", F.current_timestamp())
                   .withColumn("tower_name", F.lit("n")), RESPONSE, key="tower_id", allow_extra=True)
    assert len(resp.columns) == 17 and resp.first().severity_level is None


def test_schema_sizes():
    assert (len(TELEMETRY.fields), len(ALERT.fields), len(RESPONSE.fields)) == (9, 11, 16)
    assert "latitude" not in RESPONSE.fieldNames()


def test_tag_rules_literal_and_regex_paths_agree(spark):
    from pylonflow.operators.tagging import TOOL_RULES, _literal_alternatives, tag_by_rules
    texts = ["The consumer LAG grew", "a flag was set", "SQL window", "Connector down", "new Avro schema",
             "bytes per request", "org chart", "nothing here", None, "", "Aggregation of metrics"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, text string")
    lit = {r.id: r.tool for r in tag_by_rules(df, "text").collect()}
    # the same rules forced through the regex engine ((?:..) is regex syntax, same meaning)
    forced = [(f"(?:{p})", t) for p, t in TOOL_RULES]
    assert all(_literal_alternatives(p) is None for p, _ in forced)
    rx = {r.id: r.tool for r in tag_by_rules(df, "text", forced).collect()}
    assert lit == rx
    assert lit[0] == "list-topics" and lit[1] == "list-topics"  # "lag" hits "flag": no word boundaries
    assert lit[7] == "search-product-docs" and lit[8] == "search-product-docs"
    assert lit[10] == "list-flink-statements"


def test_golden_telemetry_record_alerts(spark):
    # documented reading: TWR-002, 91.4 C, -96.1 dBm, cpu 88.3, anomalous
    row = [("TWR-002", "Salamanca", 40.4308, -3.68, 91.4, -96.1, 88.3, datetime(2024, 7, 15, 10, 23, 45), True)]
    df = spark.createDataFrame(row, _nullable(TELEMETRY))
    assert anomaly_filter(df).count() == 1
    a = detect_alerts(df).first()
    assert (a.event_count, a.max_temperature, a.min_signal) == (1, 91.4, -96.1)
    assert escalation_filter(detect_alerts(df)).count() == 1


def test_durations_parse_one_way():
    from pylonflow.functions.timeutil import duration_us
    assert duration_us("500 ms") == 500_000 and duration_us("500 milliseconds") == 500_000
    assert duration_us("90 s") == duration_us("90 seconds") == 90_000_000
    assert duration_us("10 m") == duration_us("10 minutes") == 600_000_000
    assert duration_us("1 day 2 hours") == 93_600_000_000
    assert duration_us("0 seconds", allow_zero=True) == 0
    with pytest.raises(ValueError):
        duration_us("0 seconds")  # a window, ttl, bucket or retention of zero is a mistake
    for bad in ("", "ten seconds", "5 parsecs", "-1 s"):
        with pytest.raises(ValueError):
            duration_us(bad)


def test_short_units_work_in_every_operator(spark):
    from pylonflow.operators.episodes import red_episodes, red_episodes_stream
    from pylonflow.operators.views import tower_status
    df = spark.createDataFrame([("A", datetime(2024, 1, 1, 0, 0, 0)), ("A", datetime(2024, 1, 1, 0, 1, 30))],
                               "tower_id string, window_end timestamp")
    assert red_episodes(df, ttl="90 s").count() == 1 and red_episodes(df, ttl="89 s").count() == 2
    assert red_episodes_stream(df, ttl="90 s", watermark=None).count() == 1
    st = tower_status(df, df, datetime(2024, 1, 1, 0, 2, 59), ttl="90 s").first()
    assert st.status == "red"
    assert tower_status(df, df, datetime(2024, 1, 1, 0, 3, 0), ttl="90 s").first().status == "green"
    assert retain(df.withColumnRenamed("window_end", "ts"), "ts", "60 s").count() == 1


def test_time_operators_accept_timestamp_ntz(spark):
    from pylonflow.operators.episodes import red_episodes
    from pylonflow.operators.views import tower_status
    df = spark.createDataFrame([("A", "2024-01-01 00:00:00"), ("A", "2024-01-01 00:01:30")], "tower_id string, t string") \
        .select("tower_id", F.col("t").cast("timestamp_ntz").alias("window_end"))
    ep = red_episodes(df, ttl="90 s")
    assert ep.count() == 1 and dict(ep.dtypes)["episode_end"] == "timestamp_ntz"
    st = tower_status(df, df, F.lit("2024-01-01 00:02:00").cast("timestamp_ntz"), ttl="90 s").first()
    assert st.status == "red"
    assert retain(df.withColumnRenamed("window_end", "ts"), "ts", "60 s").count() == 1
    assert retain(df.withColumnRenamed("window_end", "ts"), "ts", "60 s",
                  as_of=datetime(2024, 1, 1, 0, 0, 59)).count() == 2


def test_ntz_episodes_ignore_session_time_zone(spark):
    """Wall-clock alert times are compared as wall clock, whatever the zone."""
    from pylonflow.operators.episodes import red_episodes
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = spark.createDataFrame([("A", "2024-03-10 02:30:00"), ("A", "2024-03-10 03:29:00")],
                                   "tower_id string, t string") \
            .select("tower_id", F.col("t").cast("timestamp_ntz").alias("window_end"))
        got = sorted((r.episode_start, r.last_alert) for r in red_episodes(df, ttl="90 s").collect())
        assert got == [(datetime(2024, 3, 10, 2, 30), datetime(2024, 3, 10, 2, 30)),
                       (datetime(2024, 3, 10, 3, 29), datetime(2024, 3, 10, 3, 29))]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
