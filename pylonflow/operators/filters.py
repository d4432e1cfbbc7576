"""Row filters and per-metric breach flags."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from pylonflow.functions.predicates import ANOMALY_RULES, ESCALATION_RULES, Rule, any_of, as_rules


def anomaly_filter(df: DataFrame, rules: Sequence[Rule | tuple] = ANOMALY_RULES) -> DataFrame:
    """Keep readings that breach any rule (row level, before aggregation).

    A plain ``filter``: Catalyst pushes it into the parquet scan
    (``PushedFilters: [Or(GreaterThan.., LessThan..)]``) and below the
    partial aggregate of ``detect_alerts``.
    """
    return df.filter(any_of(rules))


def escalation_filter(alerts: DataFrame, rules: Sequence[Rule | tuple] = ESCALATION_RULES) -> DataFrame:
    """Keep only severe alerts (window averages over the escalation limits).

    Call it *before* ``predict``: Catalyst does not push filters below
    ``mapInPandas``, so the order in code is the order of execution.
    """
    return alerts.filter(any_of(rules))


def breach_flags(df: DataFrame, rules: Sequence[Rule | tuple] = ANOMALY_RULES,
                 suffix: str = "_breach", any_col: str = "any_breach") -> DataFrame:
    """Add one boolean per rule (``<column>_breach``) and their OR.

    Flags follow SQL logic: a NULL metric gives a NULL flag, and ``any_breach``
    is NULL only when no flag is true and at least one is NULL.
    """
    rs = as_rules(rules)
    ops = {">": "gt", ">=": "ge", "<": "lt", "<=": "le", "==": "eq", "!=": "ne"}
    base = [r.column.replace("_strength", "") for r in rs]
    flags = {}
    for r, b in zip(rs, base):
        # one flag per column; a column with several rules gets one flag per comparison
        name = (b if base.count(b) == 1 else f"{b}_{ops[r.op]}_{r.value:g}".replace(".", "_").replace("-", "m"))
        flags[name + suffix] = r.expr()
    return df.withColumns(flags).withColumn(any_col, any_of(rs))
