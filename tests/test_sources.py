"""Retention, envelope encoding/decoding corner cases, readers."""

import json
from datetime import datetime, timedelta, timezone

from pyspark.sql import functions as F
from pyspark.sql import types as T

from pylonflow import decode_envelope, encode_envelope, retain
from pylonflow.sources.tables import read_table, stream_table
from tests.conftest import SF001

T0 = datetime(2024, 1, 1, 12)


def test_retain_strict_boundary_and_explicit_as_of(spark):
    df = spark.createDataFrame([(i, T0 - timedelta(hours=h)) for i, h in enumerate([0, 1, 8, 9])],
                               "id int, ts timestamp")
    assert sorted(r.id for r in retain(df, "ts").collect()) == [0, 1]          # exactly 8 h old is dropped
    assert sorted(r.id for r in retain(df, "ts", "8 hours", as_of=T0 + timedelta(hours=7.5)).collect()) == [0]
    assert sorted(r.id for r in retain(df, "ts", "10 hours").collect()) == [0, 1, 2, 3]


def test_encode_envelope_is_keyed_json(spark):
    t0 = T0.replace(tzinfo=timezone.utc)   # an instant, whatever the driver's zone
    df = spark.createDataFrame([("TWR-002", 91.4, t0)], "tower_id string, temperature double, event_time timestamp")
    r = encode_envelope(df, key="tower_id", time_col="event_time").first()
    assert bytes(r.key) == b"TWR-002" and r.timestamp.astimezone(timezone.utc) == t0 if r.timestamp.tzinfo \
        else bytes(r.key) == b"TWR-002"
    assert json.loads(bytes(r.value)) == {"tower_id": "TWR-002", "temperature": 91.4,
                                          "event_time": 1704110400000}


def test_decode_keeps_empty_object_rejects_wrong_types(spark):
    schema = T.StructType([T.StructField("tower_id", T.StringType()), T.StructField("n", T.LongType())])
    vals = [b"{}", b'{"tower_id": "a", "n": "x"}', b'{"tower_id": "b", "n": 3, "extra": true}', b"0", b"false",
            b'""']
    env = spark.createDataFrame([(None, v) for v in vals], "key binary, value binary")
    good, bad = decode_envelope(env, schema, with_rejected=True)
    assert sorted((r.tower_id or "", r.n) for r in good.collect()) == [("", None), ("b", 3)]
    assert bad.count() == 4


def test_readers_cast_ntz_and_stream_single_table(spark):
    ev = read_table(spark, SF001, "events")
    assert dict(ev.dtypes)["ts"] == "timestamp"
    st = stream_table(spark, SF001, "events")
    assert st.isStreaming and dict(st.dtypes)["ts"] == "timestamp"
    q = (st.select("event_id").writeStream.format("memory").queryName("ev_stream_probe")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    assert spark.table("ev_stream_probe").count() == ev.count()
    assert spark.table("ev_stream_probe").agg(F.countDistinct("event_id")).first()[0] == ev.count()


def test_struct_from_avro_matches_record_constants():
    from pylonflow.schemas import ALERT, RESPONSE, TELEMETRY, struct_from_avro
    ts = {"type": "long", "logicalType": "timestamp-millis"}

    def rec(fields):
        return {"type": "record", "name": "R", "fields": fields}

    tel = rec([{"name": n, "type": t} for n, t in [
        ("tower_id", "string"), ("tower_name", "string"), ("latitude", "double"), ("longitude", "double"),
        ("temperature", "double"), ("signal_strength", "double"), ("cpu_load", "double"), ("event_time", ts),
        ("is_anomaly", "boolean")]])
    assert struct_from_avro(tel)[0] == TELEMETRY
    alert = rec([{"name": "tower_id", "type": "string"}, {"name": "tower_name", "type": "string", "default": ""},
                 {"name": "latitude", "type": "double", "default": 0.0},
                 {"name": "longitude", "type": "double", "default": 0.0}]
                + [{"name": n, "type": "double"} for n in ("avg_temperature", "avg_signal", "max_temperature",
                                                           "min_signal")]
                + [{"name": "event_count", "type": "long"}, {"name": "window_start", "type": ts},
                   {"name": "window_end", "type": ts}])
    schema, defaults = struct_from_avro(json.dumps(alert))
    assert schema == ALERT and defaults == {"tower_name": "", "latitude": 0.0, "longitude": 0.0}
    resp = rec([{"name": f.name, "type": ["null", "string"], "default": None} if f.nullable
                else {"name": f.name, "type": ts if f.dataType == T.TimestampType() else
                      {"string": "string", "double": "double", "bigint": "long"}[f.dataType.simpleString()]}
                for f in RESPONSE.fields])
    assert struct_from_avro(resp)[0] == RESPONSE


def test_avro_encode_requires_package(spark):
    import pytest
    df = spark.createDataFrame([("a",)], "tower_id string")
    with pytest.raises(RuntimeError, match="spark-avro"):
        encode_envelope(df, avro_schema='{"type":"record","name":"R","fields":[]}', schema_id=1)


def test_conform_uses_defaults_of_an_equal_schema(spark):
    from pylonflow.schemas import ALERT, conform
    copy = T.StructType.fromJson(ALERT.jsonValue())   # equal, not the same object
    df = spark.createDataFrame([("T", 1.0, 2.0, 3.0, 4.0, 5, T0, T0)],
                               "tower_id string, avg_temperature double, avg_signal double, max_temperature double, "
                               "min_signal double, event_count long, window_start timestamp, window_end timestamp")
    r = conform(df, copy).first()
    assert (r.tower_name, r.latitude, r.longitude) == ("", 0.0, 0.0)


def test_avro_logical_type_defaults():
    from datetime import date, timezone

    from pylonflow.schemas import struct_from_avro
    rec = {"type": "record", "name": "R", "fields": [
        {"name": "t", "type": {"type": "long", "logicalType": "timestamp-millis"}, "default": 1704067200000},
        {"name": "d", "type": {"type": "int", "logicalType": "date"}, "default": 19723},
        {"name": "s", "type": ["null", "string"], "default": None}]}
    _, defaults = struct_from_avro(rec)
    assert defaults == {"t": datetime(2024, 1, 1, tzinfo=timezone.utc), "d": date(2024, 1, 1), "s": None}
    union = {"type": "record", "name": "R", "fields": [
        {"name": "t", "type": [{"type": "long", "logicalType": "timestamp-millis"}, "null"],
         "default": 1704067200000}]}
    assert struct_from_avro(union)[1] == {"t": datetime(2024, 1, 1, tzinfo=timezone.utc)}


def test_json_envelope_times(spark):
    from pylonflow.schemas import TELEMETRY
    tel = spark.createDataFrame([("A", "a", 1.0, 2.0, 3.0, 4.0, 5.0, "2024-01-01 00:00:00.125123", True)],
                                "tower_id string, tower_name string, latitude double, longitude double, temperature double, "
                                "signal_strength double, cpu_load double, event_time string, is_anomaly boolean") \
        .withColumn("event_time", F.col("event_time").cast("timestamp"))
    iso = decode_envelope(encode_envelope(tel, key="tower_id", time_format="iso"), TELEMETRY).first()
    assert iso.event_time == tel.first().event_time and iso.event_time.microsecond == 125123
    millis = encode_envelope(tel, key="tower_id")
    assert '"event_time":1704067200125' in millis.select(F.col("value").cast("string")).first()[0]
    assert decode_envelope(millis, TELEMETRY).first().event_time.microsecond == 125000


def test_time_fields_of_every_form(spark):
    from datetime import datetime

    from pyspark.sql import types as T
    record = T.StructType([T.StructField("t", T.TimestampType()), T.StructField("n", T.TimestampNTZType()), T.StructField("v", T.LongType())])
    texts = ['{"t": 1721039041123, "n": 1721039041123, "v": 1}', '{"t": "1721039041123", "v": 2}', '{"t": "2024-07-15T10:24:01.123Z", "v": 3}',
             '{"t": -1, "v": 4}', '{"t": "soon", "v": 5}', '{"t": 1e400, "v": 6}', '{"t": 99999999999999999999, "v": 7}', '{"t": null, "v": 8}', '{"t": {}, "v": 9}']
    env = spark.createDataFrame([(None, bytearray(x.encode())) for x in texts], "key binary, value binary")
    good, bad = decode_envelope(env, record, with_rejected=True)
    got = {r.v: r for r in good.collect()}
    at = datetime(2024, 7, 15, 10, 24, 1, 123000)
    assert [got[k].t for k in (1, 2, 3)] == [at] * 3 and got[1].n == at and got[8].t is None
    assert got[4].t == datetime(1969, 12, 31, 23, 59, 59, 999000)
    assert set(got) == {1, 2, 3, 4, 8} and bad.count() == 4


def test_stream_table_reads_folder_tables(spark, tmp_path):
    d = str(tmp_path)
    spark.range(10).withColumnRenamed("id", "event_id").write.parquet(d + "/events.parquet")
    st = stream_table(spark, d, "events")
    q = st.writeStream.format("memory").queryName("folder_table_probe").trigger(availableNow=True).start()
    q.awaitTermination()
    assert spark.table("folder_table_probe").count() == 10


def test_checkpoint_root_fallback_without_setting(monkeypatch, tmp_path):
    from pylonflow import session
    monkeypatch.setattr(session, "_LOCAL_ROOTS", {})
    monkeypatch.setenv("TMPDIR", str(tmp_path))

    class Conf:
        def get(self, k, d=None):
            return {"spark.master": "local[1]", "spark.app.id": "fake-app"}.get(k, d)

    class Ctx:
        dir = None

        def getCheckpointDir(self):
            return self.dir

        def setCheckpointDir(self, p):
            self.dir = p

    class FakeSpark:
        conf, sparkContext = Conf(), Ctx()

    fake = FakeSpark()
    fake.sparkContext = Ctx()
    root = session.checkpoint_root(fake)
    assert root == session.checkpoint_root(fake) and fake.sparkContext.dir == root
    assert root.startswith(str(tmp_path))
    # an existing context checkpoint directory is reused, not replaced
    monkeypatch.setattr(session, "_LOCAL_ROOTS", {})
    fake2 = FakeSpark()
    fake2.sparkContext = Ctx()
    fake2.sparkContext.dir = "/data/ckpt"
    assert session.checkpoint_root(fake2) == "/data/ckpt" and fake2.sparkContext.dir == "/data/ckpt"
