"""Preference formatting of chosen and rejected conversations.

The longest common prefix of turns (same role and text) is rendered once as
the prompt; what follows it in each conversation is that side's completion,
with the spans a trainer should learn from: text and end mark of assistant
turns, as code-point offsets into the completion. Headers and the other
roles' turns are masked out.

Marks that occur inside a text are broken by a space, so that a text cannot
end its own turn. Turns are ordered by turn, role, text (nulls first); a
null role reads as "unknown", a null text as empty. Where one conversation is
a prefix of the other, or both are equal, its completion is empty and has no
spans. A conversation is one row of the result, so it must fit in one;
nothing else is gathered, and no key is joined or paired with another.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pylonflow.llm.common import documents

START, END = "<|im_start|>", "<|im_end|>"


def conversation_turns(df: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role",
                       text: str = "text") -> DataFrame:
    """(key, turns array<struct<role, text>>) of every conversation; a null key is one too."""
    rows = df.select(F.col(key).alias("conv_id"), F.struct(
        F.col(turn).alias("turn"), F.coalesce(F.col(role).cast("string"), F.lit("unknown")).alias("role"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text")).alias("t"))
    got = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("t"))
    return got.select("conv_id", F.transform("t", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))).alias("turns"))


def common_prefix(a: Column, b: Column) -> Column:
    """Number of leading turns that two conversations share."""
    same = F.zip_with(a, b, lambda x, y: F.coalesce((x["role"] == y["role"]) & (x["text"] == y["text"]), F.lit(False)))
    first = F.array_position(same, F.lit(False))
    return F.when(first > 0, first - 1).otherwise(F.least(F.size(a), F.size(b))).cast("int")


def _body(t: Column) -> Column:
    clean = F.replace(F.replace(t["text"], F.lit(START), F.lit("<| im_start|>")), F.lit(END), F.lit("<| im_end|>"))
    return F.concat(clean, F.lit(END))


def _head(t: Column) -> Column:
    return F.concat(F.lit(START), t["role"], F.lit("\n"))


def render(turns: Column) -> Column:
    return F.array_join(F.transform(turns, lambda t: F.concat(_head(t), _body(t), F.lit("\n"))), "")


def trained_spans(turns: Column) -> Column:
    """[start, end) of each assistant turn's text and end mark in ``render(turns)``."""
    sizes = F.transform(turns, lambda t: F.struct(
        F.length(_head(t)).alias("head"), F.length(_body(t)).alias("body"), (t["role"] == "assistant").alias("own")))
    start = F.struct(F.lit(0).alias("at"), F.expr("CAST(array() AS array<struct<start:int,end:int>>)").alias("spans"))

    def add(acc: Column, s: Column) -> Column:
        span = F.struct((acc["at"] + s["head"]).alias("start"), (acc["at"] + s["head"] + s["body"]).alias("end"))
        return F.struct((acc["at"] + s["head"] + s["body"] + 1).alias("at"),
                        F.when(s["own"], F.concat(acc["spans"], F.array(span))).otherwise(acc["spans"]).alias("spans"))

    return F.aggregate(sizes, start, add, lambda acc: acc["spans"])


def format_preferences(pairs: DataFrame, chosen: str = "chosen", rejected: str = "rejected",
                       carry: list[str] = ()) -> DataFrame:
    """For every row with two turn arrays: prompt, the two completions and their trained spans."""
    p = pairs.select(*carry, F.col(chosen).alias("_c"), F.col(rejected).alias("_r")).withColumn(
        "prompt_turns", common_prefix(F.col("_c"), F.col("_r")))
    rest = lambda c: F.slice(F.col(c), F.col("prompt_turns") + 1, F.greatest(F.size(c), F.lit(1)))
    p = p.withColumns({"_head": F.slice("_c", F.lit(1), F.col("prompt_turns")), "_c": rest("_c"), "_r": rest("_r")})
    return p.select(*carry, "prompt_turns", render(F.col("_head")).alias("prompt"),
                    F.size("_c").alias("chosen_turns"), render(F.col("_c")).alias("chosen"),
                    trained_spans(F.col("_c")).alias("chosen_spans"),
                    F.size("_r").alias("rejected_turns"), render(F.col("_r")).alias("rejected"),
                    trained_spans(F.col("_r")).alias("rejected_spans"))


def stale_answers(convs: DataFrame) -> DataFrame:
    """Pairs from single conversations: chosen ends with the last assistant turn; rejected gives in its place the
    assistant turn before it, or an echo of the turn before it where that is the first answer.

    A conversation without an answer has both sides empty after a prompt of all its turns. Turns behind the last answer
    belong to neither side: they are kept in ``later``.
    """
    turns = F.col("turns")
    at = F.filter(F.sequence(F.lit(1), F.greatest(F.size(turns), F.lit(1))),
                  lambda i: F.element_at(turns, i)["role"] == "assistant")
    c = convs.withColumn("_answers", at).withColumn("_last", F.coalesce(F.try_element_at("_answers", F.lit(-1)), F.size(turns)))
    earlier = F.try_element_at("_answers", F.lit(-2))
    other = F.coalesce(F.try_element_at(turns, earlier)["text"],
                       F.when(F.col("_last") > 1, F.element_at(turns, F.greatest(F.col("_last") - 1, F.lit(1)))["text"]), F.lit(""))
    worse = F.concat(F.slice(turns, F.lit(1), F.col("_last") - 1),
                     F.array(F.struct(F.lit("assistant").alias("role"), other.alias("text"))))
    chosen = F.slice(turns, F.lit(1), F.col("_last"))
    later = F.slice(turns, F.col("_last") + 1, F.greatest(F.size(turns), F.lit(1)))
    return c.select("conv_id", chosen.alias("chosen"), F.when(F.size("_answers") > 0, worse).otherwise(chosen).alias("rejected"),
                    later.alias("later"))


def op10_preference_format(spark, sf_dir: str) -> DataFrame:
    pairs = stale_answers(conversation_turns(documents(spark, sf_dir, "conversations")))
    got = format_preferences(pairs, carry=["conv_id", "later"])
    listed = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws(":", s["start"].cast("string"), s["end"].cast("string"))), ",")
    return got.select("conv_id", "prompt_turns", "prompt", "chosen", listed("chosen_spans").alias("chosen_spans"),
                      "rejected", listed("rejected_spans").alias("rejected_spans"),
                      F.size("later").alias("later_turns"), render(F.col("later")).alias("later"))


OP10_SQL = r"""
WITH c AS (SELECT conv_id, list(struct_pack(role := coalesce(role, 'unknown'), text := coalesce(text, ''))
              ORDER BY turn NULLS FIRST, coalesce(role, 'unknown'), coalesce(text, '')) AS t FROM conversations GROUP BY conv_id),
a AS (SELECT *, list_filter(range(1, len(t) + 1), lambda i: t[i].role = 'assistant') AS answers FROM c),
l AS (SELECT *, coalesce(answers[len(answers)], len(t)) AS last FROM a),
p AS (SELECT conv_id, list_slice(t, last + 1, len(t)) AS la, list_slice(t, 1, last) AS ch,
        CASE WHEN len(answers) = 0 THEN list_slice(t, 1, last) ELSE list_concat(list_slice(t, 1, last - 1), [struct_pack(
          role := 'assistant', text := CASE WHEN len(answers) > 1 THEN t[answers[len(answers) - 1]].text
                                            WHEN last > 1 THEN t[last - 1].text ELSE '' END)]) END AS rj FROM l),
k AS (SELECT *, coalesce(list_min(list_filter(range(1, least(len(ch), len(rj)) + 1),
        lambda i: ch[i].role <> rj[i].role OR ch[i].text <> rj[i].text)) - 1, least(len(ch), len(rj))) AS n FROM p),
r AS (SELECT conv_id, n, list_transform(list_concat(list_concat(ch, rj), la), lambda x: struct_pack(head := '<|im_start|>' || x.role || chr(10),
        body := replace(replace(x.text, '<|im_start|>', '<| im_start|>'), '<|im_end|>', '<| im_end|>') || '<|im_end|>',
        own := x.role = 'assistant')) AS b, len(ch) AS nc, len(ch) + len(rj) AS na, len(ch) + len(rj) + len(la) AS nl FROM k),
s AS (SELECT conv_id, n, list_slice(b, 1, n) AS pr, list_slice(b, n + 1, nc) AS ch, list_slice(b, nc + n + 1, na) AS rj, list_slice(b, na + 1, nl) AS la FROM r)
SELECT conv_id, n::INTEGER AS prompt_turns,
  array_to_string(list_transform(pr, lambda x: x.head || x.body || chr(10)), '') AS prompt,
  array_to_string(list_transform(ch, lambda x: x.head || x.body || chr(10)), '') AS chosen,
  array_to_string(list_transform(list_filter(range(1, len(ch) + 1), lambda i: ch[i].own), lambda i:
    (coalesce(list_sum(list_transform(list_slice(ch, 1, i - 1), lambda y: length(y.head) + length(y.body) + 1)), 0) + length(ch[i].head))::BIGINT || ':' ||
    (coalesce(list_sum(list_transform(list_slice(ch, 1, i - 1), lambda y: length(y.head) + length(y.body) + 1)), 0) + length(ch[i].head) + length(ch[i].body))::BIGINT), ',') AS chosen_spans,
  array_to_string(list_transform(rj, lambda x: x.head || x.body || chr(10)), '') AS rejected,
  array_to_string(list_transform(list_filter(range(1, len(rj) + 1), lambda i: rj[i].own), lambda i:
    (coalesce(list_sum(list_transform(list_slice(rj, 1, i - 1), lambda y: length(y.head) + length(y.body) + 1)), 0) + length(rj[i].head))::BIGINT || ':' ||
    (coalesce(list_sum(list_transform(list_slice(rj, 1, i - 1), lambda y: length(y.head) + length(y.body) + 1)), 0) + length(rj[i].head) + length(rj[i].body))::BIGINT), ',') AS rejected_spans,
  len(la)::INTEGER AS later_turns, array_to_string(list_transform(la, lambda x: x.head || x.body || chr(10)), '') AS later
FROM s
"""
