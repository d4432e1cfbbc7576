"""Runbook generation (escalate -> prompt -> model -> response record) and
runbook parsing (labelled model text -> five structured columns)."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pylonflow.functions.predicates import ESCALATION_RULES, Rule
from pylonflow.functions.prompt import prompt_expr
from pylonflow.functions.text import labelled_lines, last_value, numbered, values_after
from pylonflow.operators.filters import escalation_filter
from pylonflow.operators.infer import CallOptions, ModelCall, ModelSpec, predict, rule_model
from pylonflow.schemas import DEFAULTS, PARSED_FIELDS, RESPONSE, conform

_CARRIED = ("tower_id", "tower_name", "window_start", "window_end",
            "avg_temperature", "avg_signal", "max_temperature", "min_signal", "event_count")


def _processed_at(as_of: datetime | str | Column | None) -> Column:
    """Write time at the record's millisecond precision; by default one value
    per query / micro-batch (``current_timestamp``)."""
    if as_of is None:
        c = F.current_timestamp()
    elif isinstance(as_of, Column):
        c = as_of
    else:
        c = F.lit(as_of).cast("timestamp")
    return F.date_trunc("millisecond", c)


def generate_runbooks(
    alerts: DataFrame,
    call: ModelCall = rule_model,
    model: ModelSpec = ModelSpec(),
    rules: Sequence[Rule | tuple] | None = ESCALATION_RULES,
    options: CallOptions = CallOptions(),
    n_callers: int | None = None,
    processed_at: datetime | str | Column | None = None,
    carry: Sequence[str] = (),
    on_error: str = "raise",
) -> DataFrame:
    """Alerts -> response records (RESPONSE schema, parsed fields NULL).

    ``carry`` names further alert columns to keep behind the record's.
    ``on_error="column"`` keeps an alert whose call failed for good with an
    empty response and the message in ``response_error``, so that one bad
    prompt does not stop the others; write such rows to a side table.

    The escalation filter and the column projection run in the JVM before the
    rows cross into Python, so only severe alerts are sent and only the nine
    carried columns plus the prompt travel over Arrow. ``rules=None`` skips
    the filter (the caller has applied it already).
    """
    severe = alerts if rules is None else escalation_filter(alerts, rules)
    severe = severe.select(*_CARRIED, *carry, prompt_expr().alias(model.input_col))
    answered = predict(severe, call, model, options=options, n_callers=n_callers, on_error=on_error)
    extra = [T.StructField(c, severe.schema[c].dataType) for c in carry]
    response = F.col(model.output_col)
    failed = []
    if on_error == "column":
        failed = [F.col(f"{model.output_col}_error").alias("response_error")]
        extra.append(T.StructField("response_error", T.StringType()))
        response = F.coalesce(response, F.lit(""))
    return conform(
        answered.select(*_CARRIED, *carry, response.alias("agent_response"), *failed,
                        _processed_at(processed_at).alias("processed_at")),
        T.StructType([*RESPONSE.fields, *extra]), defaults=DEFAULTS["response"],
    )


LABELS = ("SEVERITY", "DIAGNOSIS", "ACTION[0-9]+", "ESCALATION", "TICKET")


def fields_from_lines(lines: Column) -> dict[str, Column]:
    """The five runbook fields of the ``labelled_lines`` of a text.

    Rules: NULL/'' text -> all NULL; lines split on LF, trimmed, empties
    dropped; labels case-insensitive and anchored at line start; a label with
    no value is ignored (keeps the earlier value); for repeated labels the
    last one wins; severity and ticket are upper-cased without checking the
    allowed values; ACTION<n> lines are kept in order of appearance and
    renumbered 1..n; unlabelled lines are ignored.
    """
    return {
        "severity_level": F.upper(last_value(lines, "SEVERITY")),
        "diagnosis": last_value(lines, "DIAGNOSIS"),
        "immediate_actions": numbered(values_after(lines, "ACTION")),
        "escalation": last_value(lines, "ESCALATION"),
        "ticket_priority": F.upper(last_value(lines, "TICKET")),
    }


def parse_runbook(df: DataFrame, text_col: str = "agent_response", where: Column | None = None) -> DataFrame:
    """Add (or replace) the five parsed columns from ``text_col``.

    The text is scanned once, in a projection of its own that the five fields
    share. Rows for which ``where`` does not hold are not scanned at all;
    their fields are NULL.
    """
    tmp = "_runbook_lines"
    text = F.col(text_col) if where is None else F.when(where, F.col(text_col))
    staged = df.withColumn(tmp, labelled_lines(text, LABELS))
    return staged.withColumns(fields_from_lines(F.col(tmp))).drop(tmp)


def _falsy(c: Column) -> Column:
    return c.isNull() | (c == F.lit(""))


def enrich_if_absent(responses: DataFrame, text_col: str = "agent_response") -> DataFrame:
    """Parse only where severity is absent (NULL or '') and text is present.

    Other rows are not parsed. When the condition holds, all five fields are overwritten with the parse
    result, NULLs included, even a field that was already set; otherwise the
    row is unchanged.
    """
    parsed = "_parsed_"
    missing = {f: F.lit(None).cast("string") for f in PARSED_FIELDS if f not in responses.columns}
    base = responses.withColumns(missing) if missing else responses
    cond = _falsy(F.col("_orig_severity_level")) & ~_falsy(F.col(text_col))
    staged = parse_runbook(
        base.withColumnsRenamed({f: f"_orig_{f}" for f in PARSED_FIELDS}),
        text_col, cond,
    ).withColumnsRenamed({f: parsed + f for f in PARSED_FIELDS})
    out = staged.withColumns({
        f: F.when(cond, F.col(parsed + f)).otherwise(F.col(f"_orig_{f}")) for f in PARSED_FIELDS
    })
    return out.select(*base.columns)


def severity_default(df: DataFrame, default: str = "unknown", col: str = "severity_level",
                     output_col: str = "severity_label") -> DataFrame:
    """``coalesce(severity, default)``: only NULL is replaced, '' is kept."""
    return df.withColumn(output_col, F.coalesce(F.col(col), F.lit(default)))
