"""One configuration for the whole alerting dataflow, usable on batch tables
and on streams.

    flow = AlertingDataflow(AlertingConfig(n_callers=4), call=my_client)
    alerts = flow.alerts(telemetry_df)              # batch
    handles = flow.start(spark, telemetry_stream, root=".../flows/towers")  # restartable

Streaming layout (each query owns its checkpoint under the shared root):
telemetry stream -> alerts table -> responses table (exactly-once responder)
-> parsed runbook table, all partitioned by event hour and, with ``keep``,
held for that long; telemetry stream -> latest-reading view; alerts table ->
last-alert view, both read from the queries' own state. Status is computed at
read time from the alerts table.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from pylonflow.functions.predicates import ANOMALY_RULES, ESCALATION_RULES, Rule
from pylonflow.functions.timeutil import duration_us, is_ntz, shift_time, time_literal
from pylonflow.operators.detect import ALERT_METRICS, TOWER_KEYS, detect_alerts
from pylonflow.operators.episodes import red_episodes
from pylonflow.operators.infer import CallOptions, ModelCall, ModelSpec, rule_model
from pylonflow.operators.runbook import enrich_if_absent, generate_runbooks
from pylonflow.operators.views import latest_by_key, tower_status
from pylonflow.schemas import ALERT, RESPONSE
from pylonflow.session import scratch_path
from pylonflow.streaming.flows import Sink, answer_alerts_once, responses_table, runbook_stream
from pylonflow.streaming.live import feed_writer, read_feed, read_view, start_view
from pylonflow.streaming.retained import EventTable, consumer_generation


@dataclass(frozen=True)
class AlertingConfig:
    rules: Sequence[Rule | tuple] = ANOMALY_RULES
    window: str = "60 seconds"
    keys: Sequence[str] = TOWER_KEYS
    metrics: Sequence[tuple[str, str, str]] = ALERT_METRICS
    time_col: str = "event_time"
    watermark: str = "10 seconds"
    escalation_rules: Sequence[Rule | tuple] = ESCALATION_RULES
    model: ModelSpec = field(default_factory=ModelSpec)
    options: CallOptions = field(default_factory=CallOptions)
    n_callers: int | None = None
    status_ttl: str = "90 seconds"
    episode_bucket: str = "1 day"
    latest_values: Sequence[str] = ("tower_name", "temperature", "signal_strength", "cpu_load")
    keep: str | None = None      # how long alerts, responses and runbooks stay ("8 hours"); None: for good
    alert_feed: int | None = None       # rows of the live feeds; None: no such feed
    runbook_feed: int | None = None


@dataclass
class StreamHandles:
    alerts: StreamingQuery
    responder: StreamingQuery | None
    latest: StreamingQuery
    last_alert: StreamingQuery
    runbooks: StreamingQuery | None
    alerts_path: str
    alerts_schema: T.StructType
    responses_path: str | None   # None when the runbook stage does not apply (custom alert schema)
    latest_path: str             # checkpoints of the two view queries, whose state is the view
    last_alert_path: str
    runbooks_path: str | None
    latest_schema: T.StructType | None = None
    last_alert_schema: T.StructType | None = None
    alert_feed: StreamingQuery | None = None
    runbook_feed: StreamingQuery | None = None
    alert_feed_path: str | None = None
    runbook_feed_path: str | None = None
    runbooks_schema: T.StructType | None = None

    def queries(self) -> list[StreamingQuery]:
        """Upstream first: alerts, responder, latest, last alert, runbooks, feeds."""
        return [q for q in (self.alerts, self.responder, self.latest, self.last_alert, self.runbooks, self.alert_feed, self.runbook_feed) if q]

    def stop(self) -> None:
        for q in self.queries():
            q.stop()


class AlertingDataflow:
    def __init__(self, config: AlertingConfig = AlertingConfig(), call: ModelCall = rule_model):
        self.config = config
        self.call = call

    # --- batch (and stream-compatible) transforms ------------------------------
    def alerts(self, telemetry: DataFrame, streaming: bool = False) -> DataFrame:
        c = self.config
        return detect_alerts(telemetry, c.rules, c.window, c.keys, c.metrics, c.time_col,
                             watermark=c.watermark if streaming else None)

    def runbooks(self, alerts: DataFrame, parsed: bool = True) -> DataFrame:
        c = self.config
        out = generate_runbooks(alerts, self.call, c.model, c.escalation_rules, c.options, c.n_callers)
        return enrich_if_absent(out) if parsed else out

    def latest(self, telemetry: DataFrame) -> DataFrame:
        return latest_by_key(telemetry, (self.config.keys[0],), self.config.time_col, self.config.latest_values)

    def status(self, towers: DataFrame, alerts: DataFrame, as_of: datetime | str | Column) -> DataFrame:
        return tower_status(towers, alerts, as_of, self.config.status_ttl, key=self.config.keys[0])

    def episodes(self, alerts: DataFrame) -> DataFrame:
        c = self.config
        return red_episodes(alerts, c.status_ttl, keys=(c.keys[0],), bucket=c.episode_bucket)

    # --- streaming --------------------------------------------------------------
    def start(self, spark: SparkSession, telemetry_stream: DataFrame, available_now: bool = False,
              trigger: str = "2 seconds", root: str | None = None, on_restart: str = "resume",
              news: Callable[[DataFrame, int], None] | None = None) -> StreamHandles:
        """Start the streaming queries; returns their handles and tables.

        With ``root`` (a folder under the shared ``spark.checkpoint.dir``)
        every table and checkpoint has a fixed path, so starting again after
        a stop or a crash resumes each query where it stopped: no input is
        reprocessed and an answered alert is never sent to the model again
        (calls in flight in a failed task repeat). Without it a fresh folder
        is used (tests, one-off runs). ``on_restart="skip"`` drops the alerts
        that wait for an answer: the responder starts behind what the alerts
        table holds now, as a redeploy that must not replay would.

        With ``alert_feed`` or ``runbook_feed`` in the configuration a live
        feed of that many rows is kept; ``news`` gets the rows that each
        micro-batch brought into it, oldest first, and the batch's number.

        The responder and the runbook consumer need the alert record's
        columns (the prompt is built from them); with custom keys or metrics
        only the alert, latest-reading and last-alert queries run.
        """
        key = self.config.keys[0]
        base = (root.rstrip("/") if root else scratch_path(spark, "flow"))
        sink = lambda name: Sink(f"{base}/{name}/data", f"{base}/{name}/checkpoint")
        keep = self.config.keep
        alerts_df = self.alerts(telemetry_stream, streaming=True)
        alerts_sink, resp, lat, last, rb = (sink(n) for n in ("alerts", "responses", "latest", "last_alert",
                                                               "runbooks"))

        def _writer(df, body, ckpt):
            w = df.writeStream.outputMode("append").foreachBatch(body).option("checkpointLocation", ckpt)
            w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=trigger)
            return w.start()

        alerts_table = EventTable(alerts_sink.path, alerts_df.schema, "window_end", keep)
        alerts_table.create(spark)      # readers may start before the first batch lands
        q_alerts = _writer(alerts_df, alerts_table.writer(), alerts_sink.checkpoint)
        if available_now:
            q_alerts.awaitTermination()
        alerts_in = alerts_table.stream(spark)

        latest = self.latest(telemetry_stream)
        q_lat = start_view(latest, lat.checkpoint, available_now, trigger)
        last_alert = alerts_in.groupBy(key).agg(F.max("window_end").alias("window_end"))
        q_last = start_view(last_alert, last.checkpoint, available_now, trigger)

        q_resp = q_rb = None
        if set(ALERT.fieldNames()) <= set(alerts_df.columns):
            responses = responses_table(resp.path, keep)
            responses.create(spark)
            checkpoint, after = consumer_generation(spark, f"{base}/responses", alerts_table, on_restart)
            q_resp = _writer(alerts_table.stream(spark, after), answer_alerts_once(resp.path, self.call, self.config.model,
                                                           self.config.options, self.config.n_callers,
                                                           rules=self.config.escalation_rules, keep=keep),
                             checkpoint)
            if available_now:
                q_resp.awaitTermination()
            runbooks = runbook_stream(responses.stream(spark).select(*RESPONSE.fieldNames()))
            runbook_table = EventTable(rb.path, runbooks.schema, "window_start", keep)
            runbook_table.create(spark)
            q_rb = _writer(runbooks, runbook_table.writer(), rb.checkpoint)
            if available_now:
                q_rb.awaitTermination()

        def _feed(name, rows, limit):
            if limit is None:
                return None, None
            path = f"{base}/{name}"
            return _writer(rows, feed_writer(path, rows.schema, limit, emit=news), f"{path}/checkpoint"), path

        q_af, af_path = _feed("alert_feed", alerts_in, self.config.alert_feed)
        q_rf, rf_path = _feed("runbook_feed", runbook_table.stream(spark), self.config.runbook_feed) if q_rb else (None, None)
        return StreamHandles(q_alerts, q_resp, q_lat, q_last, q_rb, alerts_sink.path, alerts_df.schema,
                             resp.path if q_resp else None, lat.checkpoint, last.checkpoint, rb.path if q_rb else None,
                             latest.schema, last_alert.schema, q_af, q_rf, af_path, rf_path, runbooks.schema if q_rb else None)

    def read_latest(self, spark: SparkSession, handles: StreamHandles) -> DataFrame:
        return read_view(spark, handles.latest_path, handles.latest_schema, (self.config.keys[0],))

    def read_last_alert(self, spark: SparkSession, handles: StreamHandles) -> DataFrame:
        """Newest alert end per tower (the state of the last-alert query)."""
        return read_view(spark, handles.last_alert_path, handles.last_alert_schema, (self.config.keys[0],))

    def read_alert_feed(self, spark: SparkSession, handles: StreamHandles) -> DataFrame:
        """The live alert feed, newest first."""
        return read_feed(spark, handles.alert_feed_path, handles.alerts_schema)

    def read_runbook_feed(self, spark: SparkSession, handles: StreamHandles) -> DataFrame:
        """The live runbook feed, newest first."""
        return read_feed(spark, handles.runbook_feed_path, handles.runbooks_schema)

    def read_status(self, spark: SparkSession, handles: StreamHandles, as_of: datetime | str | Column,
                    towers: DataFrame | None = None, lookback: str | None = None) -> DataFrame:
        """Red/green per known tower at ``as_of`` (an explicit event time).

        Read from the alerts table itself (never behind it), so the result is
        that of ``tower_status`` on the same alerts. A ``lookback`` bounds the
        read to alerts in ``(as_of - lookback, as_of]`` (parquet statistics
        skip older files): the status stays exact, ``last_alert`` is then the
        newest alert within it, and towers known from older alerts only are
        not listed. Known towers default to the latest-reading view plus the
        towers with alerts in that range; no telemetry is scanned.
        """
        key = self.config.keys[0]
        alerts = spark.read.schema(handles.alerts_schema).parquet(handles.alerts_path)
        ntz = is_ntz(alerts, "window_end")
        now = time_literal(as_of, ntz)
        recent = alerts.filter(F.col("window_end") <= now)
        if lookback is not None:
            span = max(duration_us(lookback), duration_us(self.config.status_ttl))  # never shorter than the ttl
            recent = recent.filter(F.col("window_end") > shift_time(now, -span, ntz))
        if towers is None:
            towers = self.read_latest(spark, handles).select(key).unionByName(recent.select(key))
        return self.status(towers, recent, now)
