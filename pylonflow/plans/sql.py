"""The two continuous statements as Spark SQL over registered views.

For users who write SQL: the statements are put together from the engine's
own definitions (rules, keys, metrics, record fields, prompt), so that SQL
and DataFrame operators cannot drift apart. ``register_views`` exposes the
inputs as temporary views under names of the caller's choice and
``register_predict_udtf`` provides the lateral model call. Catalyst plans the
statements like the operators: filter below the partial aggregate,
escalation filter below the Python table function.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from pylonflow.functions.predicates import ANOMALY_RULES, ESCALATION_RULES, Rule, as_rules
from pylonflow.functions.prompt import prompt_sql
from pylonflow.operators.detect import ALERT_METRICS, TOWER_KEYS
from pylonflow.operators.infer import ModelCall, ModelSpec, rule_model
from pylonflow.operators.sql_surface import register_predict_udtf
from pylonflow.sources.tables import read_table
from pylonflow.schemas import ALERT, RESPONSE
from pylonflow.sources.readings import readings



def predicate_sql(rules: Sequence[Rule | tuple]) -> str:
    """The rules' disjunction; thresholds as double literals."""
    return " OR ".join(f"{r.column} {r.op} {float(r.value)!r}D" for r in as_rules(rules))


def detect_statement(source: str, rules: Sequence[Rule | tuple] = ANOMALY_RULES, keys: Sequence[str] = TOWER_KEYS,
                     metrics: Sequence[tuple[str, str, str]] = ALERT_METRICS, window: str = "60 seconds",
                     time_col: str = "event_time") -> str:
    columns = [*keys, *[f"{agg}({col}) AS {name}" for name, agg, col in metrics], "count(1) AS event_count",
               "span.start AS window_start", "span.end AS window_end"]
    breaching = f"SELECT *, window({time_col}, '{window}') AS span FROM {source} WHERE {predicate_sql(rules)}"
    return f"SELECT {', '.join(columns)} FROM ({breaching}) GROUP BY {', '.join(keys)}, span"


def runbook_statement(source: str, output_col: str, rules: Sequence[Rule | tuple] = ESCALATION_RULES,
                      function: str = "ml_predict") -> str:
    """One column per field of the response record: carried from the alert, the answer, or typed NULL."""
    made = {"agent_response": f"answered.{output_col}", "processed_at": "date_trunc('millisecond', current_timestamp())"}
    carried = set(ALERT.fieldNames())
    columns = [f"{made[f.name]} AS {f.name}" if f.name in made else f"severe.{f.name}" if f.name in carried
               else f"CAST(NULL AS {f.dataType.simpleString()}) AS {f.name}" for f in RESPONSE.fields]
    severe = f"SELECT *, {prompt_sql()} AS prompt FROM {source} WHERE {predicate_sql(rules)}"
    return f"SELECT {', '.join(columns)} FROM ({severe}) severe, LATERAL {function}(severe.prompt) answered"


def register_views(spark: SparkSession, sf_dir: str, telemetry: str = "pylonflow_telemetry",
                   alerts: str = "pylonflow_alerts") -> None:
    """Temporary views of the readings and of the alert statement over them (existing views of those names are replaced)."""
    readings(read_table(spark, sf_dir, "events")).createOrReplaceTempView(telemetry)
    spark.sql(detect_statement(telemetry)).createOrReplaceTempView(alerts)


def detect_alerts_sql(spark: SparkSession, sf_dir: str, alerts: str = "pylonflow_alerts") -> DataFrame:
    register_views(spark, sf_dir, alerts=alerts)
    return spark.table(alerts)


def generate_runbooks_sql(spark: SparkSession, sf_dir: str, call: ModelCall = rule_model,
                          model: ModelSpec = ModelSpec(), alerts: str = "pylonflow_alerts") -> DataFrame:
    register_views(spark, sf_dir, alerts=alerts)
    register_predict_udtf(spark, call, model)
    return spark.sql(runbook_statement(alerts, model.output_col))
