"""Threshold rules as Spark column expressions (JVM-side, codegen'd)."""

from __future__ import annotations

import operator
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

_OPS = {">": operator.gt, ">=": operator.ge, "<": operator.lt, "<=": operator.le,
        "==": operator.eq, "!=": operator.ne}


@dataclass(frozen=True)
class Rule:
    """``column <op> value``; SQL three-valued logic (a NULL metric never passes)."""

    column: str
    op: str
    value: float

    def expr(self) -> Column:
        if self.op not in _OPS:
            raise ValueError(f"unsupported comparison {self.op!r}")
        return _OPS[self.op](F.col(self.column), F.lit(self.value).cast("double"))

    @property
    def name(self) -> str:
        return self.column


# Row-level alert thresholds and window-level escalation thresholds.
ANOMALY_RULES = (Rule("temperature", ">", 85.0), Rule("signal_strength", "<", -90.0))
ESCALATION_RULES = (Rule("avg_temperature", ">", 88.0), Rule("avg_signal", "<", -93.0))


def as_rules(rules: Sequence[Rule | tuple]) -> tuple[Rule, ...]:
    return tuple(r if isinstance(r, Rule) else Rule(*r) for r in rules)


def any_of(rules: Sequence[Rule | tuple]) -> Column:
    """OR of all rules; strict comparisons exactly as written."""
    rs = as_rules(rules)
    if not rs:
        raise ValueError("at least one rule is required")
    return reduce(lambda a, b: a | b, [r.expr() for r in rs])


def all_of(rules: Sequence[Rule | tuple]) -> Column:
    rs = as_rules(rules)
    return reduce(lambda a, b: a & b, [r.expr() for r in rs])
