"""Rule-based text routing and text-part flattening."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Keyword routes (regex on lower-cased text, first match wins) and the fallback.
TOOL_RULES = (
    ("topic|stream|message|consumer|produce|offset|lag", "list-topics"),
    ("flink|statement|sql|aggregat|window", "list-flink-statements"),
    ("connector", "list-connectors"),
    ("schema|avro|registry", "list-schemas"),
    ("metric|throughput|bytes|request", "list-available-metrics"),
    ("cluster|environment|org", "list-clusters"),
)
DEFAULT_TOOL = "search-product-docs"
# Placeholders for a result without parts / without any text.
NO_RESPONSE = "(no response)"
EMPTY_RESPONSE = "(empty response)"


_REGEX_META = set("\\^$.?*+()[]{}")


def _literal_alternatives(pattern: str) -> list[str] | None:
    """``"topic|stream|lag"`` -> ``["topic", "stream", "lag"]``; None when the
    pattern uses any regex syntax beyond ``|``."""
    if any(ch in _REGEX_META for ch in pattern):
        return None
    parts = pattern.split("|")
    return parts if all(parts) else None


def _finds(low: Column, pattern: str) -> Column:
    """Regex *find* on lower-cased text. Literal alternations become OR-ed
    substring tests (same result, no regex engine: ~3x faster on long
    texts); anything else goes through ``rlike``."""
    words = _literal_alternatives(pattern)
    if words is None:
        return low.rlike(pattern)
    return reduce(lambda a, b: a | b, [low.contains(w) for w in words])


def rule_tag_lowered(low: Column, rules: Sequence[tuple[str, str]] = TOOL_RULES,
                     default: str = DEFAULT_TOOL) -> Column:
    """First rule whose pattern is found in the (already lower-cased) text
    wins; substring semantics, no word boundaries."""
    expr = None
    for pattern, tag in rules:
        hit = _finds(low, pattern)
        expr = F.when(hit, F.lit(tag)) if expr is None else expr.when(hit, F.lit(tag))
    return F.lit(default) if expr is None else expr.otherwise(F.lit(default))


def rule_tag(text: Column, rules: Sequence[tuple[str, str]] = TOOL_RULES, default: str = DEFAULT_TOOL) -> Column:
    """Expression form: ``lower(text)`` then the first matching rule's tag."""
    return rule_tag_lowered(F.lower(text), rules, default)


def tag_by_rules(df: DataFrame, text_col: str, rules: Sequence[tuple[str, str]] = TOOL_RULES,
                 default: str = DEFAULT_TOOL, output_col: str = "tool") -> DataFrame:
    """Add ``output_col`` with the routed tag. The text is lower-cased once
    in its own projection and shared by all rules (a CASE WHEN chain would
    otherwise lower-case it again in every branch it reaches)."""
    low = "_tag_lowered"
    return (df.withColumn(low, F.lower(F.col(text_col)))
            .withColumn(output_col, rule_tag_lowered(F.col(low), rules, default))
            .drop(low))


def joined_parts(parts: Column, sep: str = "\n") -> Column:
    """Text of the ``type='text'`` parts joined by ``sep``; NULL for a NULL array; a NULL text joins as ''."""
    kept = F.transform(F.filter(parts, lambda p: p["type"] == F.lit("text")),
                       lambda p: F.coalesce(p["text"], F.lit("")))
    return F.array_join(kept, sep)


def flatten_text_parts(df: DataFrame, parts_col: str, output_col: str = "text") -> DataFrame:
    """``array<struct<type,text>>`` -> its text: a NULL array gives
    ``(no response)``, an empty join ``(empty response)``. The join is a
    projection of its own, so that it is evaluated once."""
    tmp = "_joined_parts"
    text = F.col(tmp)
    out = (F.when(text.isNull(), F.lit(NO_RESPONSE)).when(text == F.lit(""), F.lit(EMPTY_RESPONSE)).otherwise(text))
    return df.withColumn(tmp, joined_parts(F.col(parts_col))).withColumn(output_col, out).drop(tmp)
