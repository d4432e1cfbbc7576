"""Line-oriented text helpers as native Spark expressions (no Python UDF).

The runbook text is scanned once, by one regular expression for all labels; what it finds, a few
short strings, is then picked apart with higher-order functions. Everything stays inside the JVM.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters a JavaScript-style trim removes (WhiteSpace and
# LineTerminator: TAB, VT, FF, SP, NBSP, OGHAM SPACE, EN QUAD..HAIR SPACE,
# NARROW NBSP, MMSP, IDEOGRAPHIC SPACE, BOM, LF, CR, LS, PS).
BLANK_CLASS = "[\\t\\n\\x0B\\f\\r \\u00A0\\u1680\\u2000-\\u200A\\u202F\\u205F\\u3000\\uFEFF\\u2028\\u2029]"
# Characters a JavaScript-style "." does not match (line terminators).
DOT = "[^\\n\\r\\u2028\\u2029]"
# The same blanks as characters.
BLANKS = ("\t\n\x0b\f\r \u00a0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u202f\u205f\u3000\ufeff\u2028\u2029")


def labelled_lines(text: Column, labels: Sequence[str]) -> Column:
    """``array<struct<label, value>>`` of the lines ``LABEL: value``, in order of appearance, by one scan of the text.

    Lines end at ``\\n``; blanks around them, and around the value, do not count. ``labels`` are regular expressions,
    matched whatever their case and given back in upper case; a label without a value is no match, and a value ends
    where a JavaScript-style ``.`` would. NULL text gives NULL.
    """
    inline = f"[{BLANK_CLASS}&&[^\\n]]"
    # d, m: a line starts after \n only. Blanks are taken possessively, so that a value starts with none.
    pattern = f"(?dmi)^{inline}*+(?:{'|'.join(labels)}):{inline}*+{DOT}+"
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    blanks = F.lit(BLANKS)
    return F.transform(found, lambda x: F.struct(
        F.upper(F.btrim(F.substring_index(x, ":", 1), blanks)).alias("label"),
        F.btrim(F.substring(x, F.instr(x, ":") + 1, F.length(x)), blanks).alias("value")))


def last_value(lines: Column, label: str) -> Column:
    """Value of the last line with ``label``; ``try_element_at`` gives NULL where there is none."""
    return F.try_element_at(F.filter(lines, lambda l: l["label"] == label), F.lit(-1))["value"]


def values_after(lines: Column, prefix: str) -> Column:
    """Values of the lines whose label starts with ``prefix``, in order of appearance."""
    return F.transform(F.filter(lines, lambda l: l["label"].startswith(prefix)), lambda l: l["value"])


def numbered(items: Column, sep: str = "\n") -> Column:
    """``[a, b]`` -> ``"1. a\\n2. b"``; an empty array gives NULL."""
    joined = F.array_join(F.transform(items, lambda x, i: F.concat((i + 1).cast("string"), F.lit(". "), x)), sep)
    return F.when(F.size(items) > 0, joined)
