"""The registered queries: one callable ``(spark, sf_dir) -> DataFrame`` each.

Every query reads the driver's tables (or frames Spark derives from them),
so its work grows with the data. Rounding of averages to 6 places happens
here, in the query wrapper, never inside an operator.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pylonflow.operators.detect import EXACT_METRICS, detect_alerts
from pylonflow.operators.episodes import red_episodes, status_changes
from pylonflow.operators.filters import anomaly_filter, breach_flags, escalation_filter
from pylonflow.operators.maintain import retain
from pylonflow.operators.runbook import enrich_if_absent, generate_runbooks, parse_runbook, severity_default
from pylonflow.operators.tagging import flatten_text_parts, tag_by_rules
from pylonflow.operators.views import alert_feed, latest_by_key, runbook_feed, tower_status
from pylonflow.functions.prompt import build_prompt
from pylonflow.functions.timeutil import shift_time
from pylonflow.schemas import ALERT, PARSED_FIELDS, conform
from pylonflow.sources.envelope import decode_envelope, encode_envelope
from pylonflow.sources.readings import readings
from pylonflow.sources.tables import read_table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Parameters of the raw-event variants and of the views.
RAW_RULES = (("value", ">", 100.0),)
RAW_METRICS = (("avg_value", "avg", "value"), ("max_value", "max", "value"), ("min_value", "min", "value"))
RAW_TTL = "2 hours"
STATUS_LOOKAHEAD = "45 seconds"
ALERT_FEED_LIMIT = 50
RUNBOOK_FEED_LIMIT = 20
DOC_RULES = (("nicht", "de-negation"), ("from,", "en-from"), ("que", "romance-que"), (" the ", "en-article"))
DOC_DEFAULT = "other"


def register(name: str):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn
    return deco


def _round_avgs(df: DataFrame, cols=("avg_temperature", "avg_signal", "avg_value")) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c), 6) for c in cols if c in df.columns})


# --- shared inputs -----------------------------------------------------------

def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "events")


def telemetry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readings(events(spark, sf_dir))


def alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return detect_alerts(telemetry(spark, sf_dir))


def raw_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return detect_alerts(events(spark, sf_dir), rules=RAW_RULES, window="1 hour", keys=("user_id",),
                         metrics=RAW_METRICS, time_col="ts")


def responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return generate_runbooks(alerts(spark, sf_dir))


# --- filters, flags, sink contract ------------------------------------------

@register("anomaly_filter")
def q_anomaly_filter(spark, sf_dir):
    return anomaly_filter(telemetry(spark, sf_dir))


@register("breach_flags")
def q_breach_flags(spark, sf_dir):
    return breach_flags(telemetry(spark, sf_dir)).select(
        "tower_id", "event_time", "temperature", "signal_strength",
        "temperature_breach", "signal_breach", "any_breach")


@register("conform_alerts")
def q_conform_alerts(spark, sf_dir):
    """Alerts grouped by tower id only, conformed to the alert record:
    name and coordinates take the record defaults."""
    by_id = detect_alerts(telemetry(spark, sf_dir), keys=("tower_id",))
    return _round_avgs(conform(by_id, ALERT))


# --- detection ---------------------------------------------------------------

@register("detect_alerts_60s")
def q_detect_alerts_60s(spark, sf_dir):
    return _round_avgs(alerts(spark, sf_dir))


@register("detect_alerts_exact")
def q_detect_alerts_exact(spark, sf_dir):
    """Alerts whose averages do not depend on the order of the readings: nothing is rounded to compare them."""
    return detect_alerts(telemetry(spark, sf_dir), metrics=EXACT_METRICS)


@register("detect_alerts_1h_raw_events")
def q_detect_alerts_1h_raw_events(spark, sf_dir):
    return _round_avgs(raw_alerts(spark, sf_dir))


# --- escalation, prompt, model, runbooks --------------------------------------

@register("escalated_alerts")
def q_escalated_alerts(spark, sf_dir):
    return _round_avgs(escalation_filter(alerts(spark, sf_dir)))


@register("alert_prompts")
def q_alert_prompts(spark, sf_dir):
    return build_prompt(alerts(spark, sf_dir)).select("tower_id", "window_start", "window_end", "prompt")


@register("generate_runbooks")
def q_generate_runbooks(spark, sf_dir):
    return _round_avgs(responses(spark, sf_dir).drop("processed_at"))


@register("parse_runbook")
def q_parse_runbook(spark, sf_dir):
    return parse_runbook(responses(spark, sf_dir)).select("tower_id", "window_start", *PARSED_FIELDS)


@register("parse_runbook_text")
def q_parse_runbook_text(spark, sf_dir):
    conv = read_table(spark, sf_dir, "conversations")
    return parse_runbook(conv, "text").select("conv_id", "turn", *PARSED_FIELDS)


def _mixed_responses(spark, sf_dir) -> DataFrame:
    """Responses in mixed states: rows with an even event count already carry
    a severity, every row carries a diagnosis."""
    even = (F.col("event_count") % 2) == 0
    return responses(spark, sf_dir).withColumns({
        "severity_level": F.when(even, F.lit("PRESET")),
        "diagnosis": F.lit("kept"),
    })


@register("enrich_if_absent")
def q_enrich_if_absent(spark, sf_dir):
    return enrich_if_absent(_mixed_responses(spark, sf_dir)).select("tower_id", "window_start", *PARSED_FIELDS)


@register("severity_default")
def q_severity_default(spark, sf_dir):
    """Rows whose text is missing stay unparsed and show the default label."""
    even = (F.col("event_count") % 2) == 0
    raw = responses(spark, sf_dir).withColumn("agent_response", F.when(~even, F.col("agent_response")))
    return severity_default(enrich_if_absent(raw)).select("tower_id", "window_start", "severity_level",
                                                          "severity_label")


# --- live views ----------------------------------------------------------------

@register("latest_by_tower")
def q_latest_by_tower(spark, sf_dir):
    return latest_by_key(telemetry(spark, sf_dir))


@register("latest_by_user_raw_events")
def q_latest_by_user_raw_events(spark, sf_dir):
    return latest_by_key(events(spark, sf_dir), keys=("user_id",), time_col="ts",
                         value_cols=("event_id", "event_type", "value"), tie_col="event_id")


@register("alert_feed")
def q_alert_feed(spark, sf_dir):
    return _round_avgs(alert_feed(alerts(spark, sf_dir), ALERT_FEED_LIMIT))


@register("alert_feed_all")
def q_alert_feed_all(spark, sf_dir):
    """Every alert, newest first."""
    return _round_avgs(alert_feed(alerts(spark, sf_dir)))


@register("runbook_feed")
def q_runbook_feed(spark, sf_dir):
    feed = runbook_feed(severity_default(enrich_if_absent(responses(spark, sf_dir))), RUNBOOK_FEED_LIMIT)
    return _round_avgs(feed.drop("processed_at"))


@register("tower_status")
def q_tower_status(spark, sf_dir):
    a = alerts(spark, sf_dir)
    as_of = a.select(shift_time(F.max("window_end"), STATUS_LOOKAHEAD)).scalar()
    return tower_status(telemetry(spark, sf_dir), a, as_of)


@register("red_episodes")
def q_red_episodes(spark, sf_dir):
    return red_episodes(alerts(spark, sf_dir))


@register("red_episodes_raw_events")
def q_red_episodes_raw_events(spark, sf_dir):
    return red_episodes(raw_alerts(spark, sf_dir), ttl=RAW_TTL, keys=("user_id",))


@register("status_changes")
def q_status_changes(spark, sf_dir):
    return status_changes(alerts(spark, sf_dir))


# --- sources, maintenance, text rules --------------------------------------

@register("retain")
def q_retain(spark, sf_dir):
    return retain(events(spark, sf_dir), "ts", "8 hours")


@register("decode_envelope")
def q_decode_envelope(spark, sf_dir):
    """A mixed topic: event properties (JSON objects) and conversation turns
    (free text, rejected by the decoder)."""
    ev = events(spark, sf_dir).select(F.col("user_id").cast("string").alias("k"), F.col("props"), F.col("ts"))
    conv = read_table(spark, sf_dir, "conversations").select(
        F.concat_ws("-", "conv_id", "turn").alias("k"), F.col("text").alias("props"), F.lit(None).cast("timestamp"))
    env = ev.unionByName(conv.toDF("k", "props", "ts")).select(
        F.col("k").cast("binary").alias("key"), F.col("props").cast("binary").alias("value"),
        F.col("ts").alias("timestamp"))
    decoded = decode_envelope(env, T.StructType([T.StructField("k", T.LongType())]))
    return decoded.select(F.col("key").cast("string").alias("msg_key"), "k", "timestamp")


@register("encode_decode_roundtrip")
def q_encode_decode_roundtrip(spark, sf_dir):
    from pylonflow.schemas import TELEMETRY
    env = encode_envelope(telemetry(spark, sf_dir), key="tower_id", time_col="event_time")
    return decode_envelope(env, TELEMETRY).drop("key", "timestamp")


@register("decode_records")
def q_decode_records(spark, sf_dir):
    """JSON records with times as epoch milliseconds (or, every fifth, ISO text)."""
    iso = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSXXX")
    ms = F.unix_millis(F.col("ts").cast("timestamp")).cast("string")
    time = F.when(F.col("event_id") % 5 == 0, F.concat(F.lit('"'), iso, F.lit('"'))).otherwise(ms)
    env = events(spark, sf_dir).select(
        F.col("event_id").cast("string").cast("binary").alias("key"),
        F.concat(F.lit('{"event_time": '), time, F.lit(', "temperature": '), F.col("value").cast("string"),
                 F.lit("}")).cast("binary").alias("value"))
    record = T.StructType([T.StructField("event_time", T.TimestampType(), False), T.StructField("temperature", T.DoubleType())])
    return decode_envelope(env, record).select(F.col("key").cast("string").alias("msg_key"), "event_time", "temperature")


@register("parse_runbook_forms")
def q_parse_runbook_forms(spark, sf_dir):
    """Answers put together from table columns in awkward forms: mixed case,
    carriage returns, repeated and bare labels, actions out of order, NULL text."""
    user = F.col("user_id")
    lines = F.concat(
        F.lit("  severity: "), "event_type", F.lit("\r\nSeverity:\nDIAGNOSIS: v "), "event_type",
        F.lit("\n\nACTION9: last "), user.cast("string"), F.lit("\naction2:\tcheck "), "event_type",
        F.lit("\nnote "), "event_type", F.lit("\nACTION1: first\nTicket: p"), (user % 4).cast("string"), F.lit("\n"),
        F.when(F.col("event_type") == "click", F.lit("ESCALATION:"))
        .otherwise(F.concat(F.lit("escalation: lead "), (user % 3).cast("string"))),
        F.lit("\n"), F.when(user % 2 == 0, F.lit("SEVERITY: high")).otherwise(F.lit("DIAGNOSIS:")))
    answers = events(spark, sf_dir).withColumn("answer", F.when(F.col("event_type") != "view", lines))
    return parse_runbook(answers, "answer").select("event_id", *PARSED_FIELDS)


@register("tag_by_rules")
def q_tag_by_rules(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents")
    return tag_by_rules(docs, "text", DOC_RULES, DOC_DEFAULT).select("doc_id", "tool")


@register("tag_by_rules_default")
def q_tag_by_rules_default(spark, sf_dir):
    conv = read_table(spark, sf_dir, "conversations")
    return tag_by_rules(conv, "text").select("conv_id", "turn", "tool")


@register("flatten_text_parts")
def q_flatten_text_parts(spark, sf_dir):
    """Each turn as a list of line parts; only assistant lines are text."""
    conv = read_table(spark, sf_dir, "conversations")
    parts = F.transform(F.split("text", "\n"), lambda l: F.struct(
        F.when(F.col("role") != F.lit("assistant"), F.col("role"))
         .when(l == F.lit(""), F.lit("blank")).otherwise(F.lit("text")).alias("type"),
        l.alias("text")))
    return flatten_text_parts(conv.withColumn("parts", parts), "parts", "flat").select("conv_id", "turn", "flat")


# --- streaming twins (run to completion with an available-now trigger) ----------

STREAM_DELAY = "10 seconds"
STREAM_FILES = 3


def event_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as a stream of several ranges of event time, one a micro-batch; rows without time are in the first.

    A range has as many files as its share of the table has, all of them in one trigger.
    """
    from pylonflow.session import scratch_path
    table, path = events(spark, sf_dir), scratch_path(spark, "event_files")
    cuts = table.agg(*[F.percentile_approx("ts", (k + 1) / STREAM_FILES).alias(f"c{k}") for k in range(STREAM_FILES - 1)]).first()
    at = sum((F.when(F.col("ts") > F.lit(c), 1).otherwise(0) for c in cuts if c is not None), F.lit(0))
    files = max(1, -(-len(table.inputFiles()) // STREAM_FILES))
    for k in range(STREAM_FILES):   # one append after another: the source takes files by age
        table.filter(at == k).repartition(files, "event_id").write.mode("append").parquet(path)
    return spark.readStream.schema(table.schema).option("maxFilesPerTrigger", files).parquet(path)


@register("stream_detect_alerts")
def q_stream_detect_alerts(spark, sf_dir):
    """Events as a file stream -> closed 60 s alerts in a parquet sink."""
    from pylonflow.sources.tables import stream_table
    from pylonflow.streaming.flows import Sink, alerts_stream, run_to_sink
    out = run_to_sink(alerts_stream(stream_table(spark, sf_dir, "events"), STREAM_DELAY),
                      Sink.fresh(spark, "stream_detect_alerts"))
    return _round_avgs(out)


@register("stream_detect_alerts_exact")
def q_stream_detect_alerts_exact(spark, sf_dir):
    """The same on a stream of several micro-batches."""
    from pylonflow.streaming.flows import Sink, run_to_sink
    closed = detect_alerts(readings(event_files(spark, sf_dir)), metrics=EXACT_METRICS, watermark=STREAM_DELAY)
    return run_to_sink(closed, Sink.fresh(spark, "stream_detect_alerts_exact"))


@register("stream_chain")
def q_stream_chain(spark, sf_dir):
    """Two chained streaming statements over several micro-batches: events -> alerts table -> runbooks."""
    from pylonflow.streaming.flows import ALERT_IDENTITY, responses_table, run_chain
    _, responses = run_chain(spark, event_files(spark, sf_dir), STREAM_DELAY)
    return _round_avgs(responses_table(responses.path).read(spark).drop("key", "processed_at", ALERT_IDENTITY))


@register("stream_red_episodes")
def q_stream_red_episodes(spark, sf_dir):
    """Closed alerts stream -> session-window episodes (append mode)."""
    from pylonflow.operators.episodes import red_episodes_stream
    from pylonflow.sources.tables import stream_table
    from pylonflow.streaming.flows import Sink, alerts_stream, run_to_sink
    a_sink = Sink.fresh(spark, "stream_alerts")
    run_to_sink(alerts_stream(stream_table(spark, sf_dir, "events"), STREAM_DELAY), a_sink)
    alerts_in = spark.readStream.schema(ALERT).parquet(a_sink.path)
    return run_to_sink(red_episodes_stream(alerts_in, watermark=STREAM_DELAY), Sink.fresh(spark, "stream_episodes"))


@register("stream_latest_by_tower")
def q_stream_latest_by_tower(spark, sf_dir):
    """Latest reading per tower, read from the state of a streaming aggregate."""
    from pylonflow.session import scratch_path
    from pylonflow.sources.tables import stream_table
    from pylonflow.streaming.live import run_view
    tel = readings(stream_table(spark, sf_dir, "events"))
    return run_view(latest_by_key(tel), scratch_path(spark, "latest_by_tower"), ("tower_id",))


@register("stream_tower_status")
def q_stream_tower_status(spark, sf_dir):
    """Closed alerts stream -> last alert per tower (a state view); status is
    computed at read time against the known towers."""
    from pylonflow.session import scratch_path
    from pylonflow.sources.tables import stream_table
    from pylonflow.streaming.flows import Sink, alerts_stream, run_to_sink
    from pylonflow.streaming.live import run_view
    a_sink = Sink.fresh(spark, "status_alerts")
    closed = run_to_sink(alerts_stream(stream_table(spark, sf_dir, "events"), STREAM_DELAY), a_sink)
    last = (spark.readStream.schema(ALERT).parquet(a_sink.path)
            .groupBy("tower_id").agg(F.max("window_end").alias("window_end")))
    snapshot = run_view(last, scratch_path(spark, "last_alert"), ("tower_id",))
    as_of = closed.select(shift_time(F.max("window_end"), STATUS_LOOKAHEAD)).scalar()
    return tower_status(telemetry(spark, sf_dir), snapshot, as_of)


@register("stream_status_changes")
def q_stream_status_changes(spark, sf_dir):
    """Closed alerts stream -> live red/green changes (stateful, event-time
    timeout for the return to green)."""
    from pylonflow.streaming.flows import Sink, alerts_stream, run_to_sink
    from pylonflow.streaming.status import status_changes_stream
    a_sink = Sink.fresh(spark, "changes_alerts")
    run_to_sink(alerts_stream(event_files(spark, sf_dir), STREAM_DELAY), a_sink)
    alerts_in = spark.readStream.schema(ALERT).parquet(a_sink.path)
    return run_to_sink(status_changes_stream(alerts_in, watermark=STREAM_DELAY),
                       Sink.fresh(spark, "status_changes"))


@register("stream_runbook_feed")
def q_stream_runbook_feed(spark, sf_dir):
    """Chained statements, then a third consumer parses the responses stream
    into runbook fields and persists them."""
    from pylonflow.schemas import RESPONSE
    from pylonflow.sources.tables import stream_table
    from pylonflow.streaming.flows import Sink, responses_table, run_chain, run_to_sink, runbook_stream
    _, responses = run_chain(spark, stream_table(spark, sf_dir, "events"), STREAM_DELAY)
    resp_in = responses_table(responses.path).stream(spark).select(*RESPONSE.fieldNames())
    out = run_to_sink(runbook_stream(resp_in), Sink.fresh(spark, "runbooks"))
    return _round_avgs(out.drop("processed_at"))


@register("stream_alert_feed")
def q_stream_alert_feed(spark, sf_dir):
    """Closed alerts stream -> live feed of the newest alerts, several micro-batches; the state is the feed itself."""
    from pylonflow.session import scratch_path
    from pylonflow.streaming.flows import Sink, alerts_stream, run_to_sink
    from pylonflow.streaming.live import feed_writer, read_feed
    a_sink = Sink.fresh(spark, "feed_alerts")
    closed = run_to_sink(alerts_stream(event_files(spark, sf_dir), STREAM_DELAY), a_sink)
    files = max(1, -(-len(closed.inputFiles()) // STREAM_FILES))    # the feed's batches are no more when the alerts fill more files
    alerts_in = spark.readStream.schema(ALERT).option("maxFilesPerTrigger", files).parquet(a_sink.path)
    base = scratch_path(spark, "alert_feed")
    (alerts_in.writeStream.foreachBatch(feed_writer(base, ALERT, ALERT_FEED_LIMIT)).option("checkpointLocation", base + "/checkpoint")
     .trigger(availableNow=True).start().awaitTermination())
    return _round_avgs(read_feed(spark, base, ALERT))


@register("stream_late_rows")
def q_stream_late_rows(spark, sf_dir):
    """Readings in order of arrival (event id), in several micro-batches: those whose window the watermark had closed."""
    from pylonflow.session import scratch_path
    from pylonflow.streaming.late import late_row_writer, read_late_rows
    table, path = events(spark, sf_dir), scratch_path(spark, "arrivals")
    last = table.agg(F.max("event_id")).first()[0] or 0
    arrival = F.when(F.col("event_id") % 50 == 7, F.col("event_id") + (last // 2)).otherwise(F.col("event_id"))   # some come late
    third = F.least(F.floor(arrival * STREAM_FILES / F.lit(last + 1)), F.lit(STREAM_FILES - 1))
    for k in range(STREAM_FILES):
        table.where(third == k).repartition(1, "event_id").write.mode("append").parquet(path)
    stream = spark.readStream.schema(table.schema).option("maxFilesPerTrigger", 1).parquet(path)
    base = scratch_path(spark, "late")
    (stream.writeStream.foreachBatch(late_row_writer(base, "ts", "60 seconds", STREAM_DELAY)).option("checkpointLocation", base + "/checkpoint")
     .trigger(availableNow=True).start().awaitTermination())
    return read_late_rows(spark, base, table.schema, "ts").select("event_id", "ts", "event_type")


# --- the same statements written in Spark SQL ----------------------------------

@register("sql_detect_alerts")
def q_sql_detect_alerts(spark, sf_dir):
    from pylonflow.plans.sql import detect_alerts_sql
    return _round_avgs(detect_alerts_sql(spark, sf_dir))


@register("sql_generate_runbooks")
def q_sql_generate_runbooks(spark, sf_dir):
    from pylonflow.plans.sql import generate_runbooks_sql
    return _round_avgs(generate_runbooks_sql(spark, sf_dir).drop("processed_at"))
