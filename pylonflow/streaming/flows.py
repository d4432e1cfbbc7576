"""Structured Streaming wiring: sources, sinks, chained stages.

The transforms are the batch operators unchanged; this module adds the
stream-only parts: watermarks, append-mode sinks with their own checkpoints,
statement chaining through a durable table, and an exactly-once guard around
the model call.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from pylonflow.functions.predicates import ESCALATION_RULES
from pylonflow.operators.detect import TOWER_KEYS, detect_alerts
from pylonflow.operators.filters import escalation_filter
from pylonflow.operators.infer import CallOptions, ModelCall, ModelSpec, rule_model
from pylonflow.operators.runbook import generate_runbooks
from pylonflow.schemas import ALERT, DEFAULTS, RESPONSE, conform
from pylonflow.session import scratch_path
from pylonflow.sources.readings import readings
from pylonflow.streaming.retained import EventTable, hour_of, is_missing_table

ALERT_IDENTITY = "alert_identity"   # stored next to each response: the hash of its alert's grouping keys


def alert_identity(alerts: DataFrame) -> Column:
    """What makes an alert one of a kind: all grouping attributes (those of the
    response record and those it lacks) and its window, NULLs told from ''."""
    parts = [c for c in (*TOWER_KEYS, "window_start", "window_end") if c in alerts.columns]
    return F.sha2(F.to_json(F.struct(*[F.coalesce(F.col(c).cast("string"), F.lit("\x00")).alias(c) for c in parts])), 256)


@dataclass(frozen=True)
class Sink:
    """A durable table (parquet folder) and the checkpoint of the query
    writing it. One checkpoint per query; never shared."""

    path: str
    checkpoint: str

    @classmethod
    def fresh(cls, spark: SparkSession, name: str) -> "Sink":
        base = scratch_path(spark, name)
        return cls(base + "/data", base + "/checkpoint")


def start_sink(df: DataFrame, sink: Sink, output_mode: str = "append", available_now: bool = True,
               processing_time: str | None = None, partition_by: tuple[str, ...] = (),
               query_name: str | None = None) -> StreamingQuery:
    """Start ``df`` into a parquet sink (append). The file sink is
    exactly-once: a restart from the checkpoint re-commits nothing twice."""
    w = df.writeStream.format("parquet").outputMode(output_mode).option("checkpointLocation", sink.checkpoint)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if query_name:
        w = w.queryName(query_name)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time or "2 seconds")
    return w.start(sink.path)


def run_to_sink(df: DataFrame, sink: Sink, **kw) -> DataFrame:
    """Drain the currently available input into the sink, then read it back; an input without rows leaves it empty."""
    q = start_sink(df, sink, **kw)
    q.awaitTermination()
    if q.exception():
        raise q.exception()
    try:    # a sink without a file has no schema of its own
        return df.sparkSession.read.schema(df.schema).parquet(sink.path)
    except AnalysisException as exc:
        if not is_missing_table(exc):
            raise
        return df.sparkSession.createDataFrame([], df.schema)


# --- stage A: telemetry -> alerts ----------------------------------------------

def alerts_stream(events_stream: DataFrame, delay: str = "10 seconds") -> DataFrame:
    """Event stream -> telemetry -> closed 60 s alerts (append mode)."""
    return detect_alerts(readings(events_stream), watermark=delay)


# --- stage B: alerts -> runbooks, exactly once per alert ------------------------

RESPONSE_ROW = T.StructType([T.StructField("key", T.BinaryType()), *RESPONSE.fields, T.StructField(ALERT_IDENTITY, T.StringType())])


def responses_table(path: str, keep: str | None = None) -> EventTable:
    """Responses with their alert's identity, by the hour of the alert's window."""
    return EventTable(path, RESPONSE_ROW, "window_start", keep)


def answered_in(table: EventTable, alerts: DataFrame) -> DataFrame:
    """Identities of the answered alerts of the hours that ``alerts`` fall into; no other folder is listed."""
    hours = [r[0] for r in alerts.select(hour_of(table.time_col)).distinct().collect()]    # the hours of one micro-batch
    return table.read(alerts.sparkSession, hours).select(ALERT_IDENTITY)


def answer_alerts_once(
    responses_path: str,
    call: ModelCall = rule_model,
    model: ModelSpec = ModelSpec(),
    options: CallOptions = CallOptions(),
    n_callers: int | None = None,
    rules=ESCALATION_RULES,
    keep: str | None = None,
) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` body that calls the model at most once per alert.

    A micro-batch first drops the alerts that already have a response, by a
    left-anti join on the alert's whole identity (every grouping attribute and
    the window): answered alerts are not sent again, and siblings that share
    tower and window are told apart. Responses are partitioned by the hour of
    the window, and a batch reads the hours of its own alerts only, so what a
    batch costs does not grow with the history. Identity and response are one
    row, written by one batch into its own partitions. Calls that were in
    flight in a task or batch that failed before its write are repeated
    (at-least-once calls, exactly-once responses). ``rules=None`` answers
    every alert; ``keep`` lets old responses go, after which a replay of an
    alert as old as that would be answered anew.
    """
    table = responses_table(responses_path, keep)
    store = table.writer(replays=False)

    def body(batch: DataFrame, batch_id: int) -> None:
        batch.persist()  # read once: it feeds the hours and the anti-join
        try:
            severe = batch if rules is None else escalation_filter(batch, rules)
            severe = severe.withColumn(ALERT_IDENTITY, alert_identity(severe))
            # hours that this batch wrote before a stop are whole: they count as answered and stay as they are
            severe = severe.join(answered_in(table, severe), ALERT_IDENTITY, "left_anti")
            out = generate_runbooks(severe, call, model, rules=None, options=options, n_callers=n_callers,
                                    carry=(ALERT_IDENTITY,))
            record = conform(out, T.StructType([*RESPONSE.fields, T.StructField(ALERT_IDENTITY, T.StringType())]),
                             defaults=DEFAULTS["response"], key="tower_id")
            store(record, batch_id)
        finally:
            batch.unpersist()

    return body


def run_chain(spark: SparkSession, events_stream: DataFrame, delay: str = "10 seconds",
              call: ModelCall = rule_model, alerts_topic=None, responses_topic=None) -> tuple:
    """Two chained streaming statements with a topic between them:
    events -> ``alerts`` topic (keyed by tower); ``alerts`` topic ->
    exactly-once responder -> ``responses`` table. Each statement owns its
    checkpoint. Returns the two topics."""
    from pylonflow.streaming.topics import file_topic, read_topic, write_topic
    alerts_topic = alerts_topic or file_topic(spark, "anomaly-alerts", ALERT)
    responses_topic = responses_topic or file_topic(spark, "ai-agent-responses", RESPONSE)
    q = write_topic(alerts_stream(events_stream, delay), alerts_topic,
                    scratch_path(spark, "consumers", "detector"), available_now=True)
    q.awaitTermination()
    alerts_in = read_topic(spark, alerts_topic).drop("key")
    q = (alerts_in.writeStream.foreachBatch(answer_alerts_once(responses_topic.path, call))
         .option("checkpointLocation", scratch_path(spark, "consumers", "responder"))
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return alerts_topic, responses_topic


def partition_by_key(df: DataFrame, n: int = 3, key: str = "tower_id") -> DataFrame:
    """Hash-partition by the message key into ``n`` partitions, like a bus
    topic's partitions: all rows of one key land in the same partition. Use
    it where a sink needs key co-location, not to spread compute (a hot key
    stays in one partition by definition)."""
    return df.repartition(n, key)


def runbook_stream(responses_stream: DataFrame) -> DataFrame:
    """Responses stream -> parsed runbooks (raw text kept). Stateless, so it
    runs in append mode and the parse is persisted once instead of being
    redone by every reader."""
    from pylonflow.operators.runbook import enrich_if_absent
    return enrich_if_absent(responses_stream)


def late_groups_dropped(query: StreamingQuery) -> int:
    """Groups that the query's stateful operators dropped as late, over the
    progress reports Spark still keeps. It counts after the partial
    aggregation, per group and batch; ``late.late_row_writer`` counts and keeps rows."""
    total = 0
    for p in query.recentProgress:
        for op in p.get("stateOperators") or []:
            total += int(op.get("numRowsDroppedByWatermark", 0))
    return total
