"""pylonflow: a Spark-native telemetry alerting engine.

Every operator is a pure function ``DataFrame -> DataFrame`` that works on
batch tables and, where it makes sense, on Structured Streaming frames.
Public names are resolved lazily so importing the package stays cheap.
"""

from importlib import import_module

_EXPORTS = {
    "ALERT": "pylonflow.schemas", "RESPONSE": "pylonflow.schemas", "TELEMETRY": "pylonflow.schemas",
    "conform": "pylonflow.schemas",
    "anomaly_filter": "pylonflow.operators.filters", "breach_flags": "pylonflow.operators.filters",
    "escalation_filter": "pylonflow.operators.filters",
    "detect_alerts": "pylonflow.operators.detect",
    "ModelSpec": "pylonflow.operators.infer", "predict": "pylonflow.operators.infer",
    "rule_model": "pylonflow.operators.infer",
    "generate_runbooks": "pylonflow.operators.runbook", "parse_runbook": "pylonflow.operators.runbook",
    "enrich_if_absent": "pylonflow.operators.runbook", "severity_default": "pylonflow.operators.runbook",
    "latest_by_key": "pylonflow.operators.views", "latest_by_tower": "pylonflow.operators.views", "alert_feed": "pylonflow.operators.views",
    "runbook_feed": "pylonflow.operators.views", "tower_status": "pylonflow.operators.views",
    "red_episodes": "pylonflow.operators.episodes", "status_changes": "pylonflow.operators.episodes",
    "retain": "pylonflow.operators.maintain",
    "tag_by_rules": "pylonflow.operators.tagging", "flatten_text_parts": "pylonflow.operators.tagging",
    "build_prompt": "pylonflow.functions.prompt",
    "Topic": "pylonflow.streaming.topics", "read_topic": "pylonflow.streaming.topics",
    "write_topic": "pylonflow.streaming.topics",
    "status_changes_stream": "pylonflow.streaming.status", "red_episodes_stream": "pylonflow.operators.episodes",
    "AlertingDataflow": "pylonflow.plans.dataflow", "AlertingConfig": "pylonflow.plans.dataflow",
    "decode_envelope": "pylonflow.sources.envelope", "encode_envelope": "pylonflow.sources.envelope",
}

__all__ = sorted(_EXPORTS)


def __getattr__(name):
    if name in _EXPORTS:
        return getattr(import_module(_EXPORTS[name]), name)
    raise AttributeError(name)
