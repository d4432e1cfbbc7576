"""The per-alert prompt handed to the model (one string per alert)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The prompt's lines: (label, column, unit) parts. Numbers are rounded HALF_UP to one place, e.g. "90.7".
PROMPT_LINES = (
    (("Tower:", "tower_id", ""), (" ", "tower_name", "")),
    (("AvgTemp:", "round(avg_temperature, 1)", "C"), (" MaxTemp:", "round(max_temperature, 1)", "C")),
    (("AvgSig:", "round(avg_signal, 1)", "dBm"), (" MinSig:", "round(min_signal, 1)", "dBm")),
    (("Events:", "event_count", ""),),
)


def prompt_sql() -> str:
    """The prompt as one Spark SQL expression (``concat`` is NULL-propagating: a NULL field gives a NULL prompt)."""
    lines = ["".join(f"'{label}', CAST({value} AS STRING), '{unit}', " for label, value, unit in line) for line in PROMPT_LINES]
    return "concat(" + "char(10), ".join(lines).rstrip(", ") + ")"


def prompt_expr() -> Column:
    return F.expr(prompt_sql())


def build_prompt(alerts: DataFrame, output_col: str = "prompt") -> DataFrame:
    return alerts.withColumn(output_col, prompt_expr())
