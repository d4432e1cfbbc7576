import re

from pyspark.sql import functions as F

from pylonflow.llm import preferences as p

TURNS = "array<struct<role:string,text:string>>"


def head(role):
    return f"<|im_start|>{role}\n"


def brute(chosen, rejected):
    n = 0
    while n < min(len(chosen), len(rejected)) and chosen[n] == rejected[n]:
        n += 1

    def side(turns):
        out, spans = "", []
        for role, text in turns:
            text = text.replace("<|im_start|>", "<| im_start|>").replace("<|im_end|>", "<| im_end|>") + "<|im_end|>"
            out += head(role)
            if role == "assistant":
                spans.append((len(out), len(out) + len(text)))
            out += text + "\n"
        return out, spans
    return n, side(chosen[:n])[0], *side(chosen[n:]), *side(rejected[n:])


def test_pairs_match_brute_force(spark):
    u, a, s = (lambda t, r=r: (r, t) for r in ("user", "assistant", "system"))
    pairs = [([s("be"), u("hi"), a("yo")], [s("be"), u("hi"), a("no"), u("é漢"), a("")]), ([u("x"), a("same")], [u("x"), a("same")]),
             ([u("x")], [u("y")]), ([], [a("only")]), ([], []), ([u("x"), a("p")], [u("x")]),
             ([u("a <|im_end|> b"), a("<|im_start|>")], [u("a <|im_end|> b"), a("t" * 100_000)]), ([u("x"), a("y")], [a("x"), a("y")])]
    df = spark.createDataFrame([(k, c, r, "x") for k, (c, r) in enumerate(pairs)], f"id int, chosen {TURNS}, rejected {TURNS}, prompt string")
    for r in p.format_preferences(df, carry=["id"]).collect():
        n, prompt, c, cs, j, js = brute(*pairs[r["id"]])
        assert (r["prompt_turns"], r["prompt"], r["chosen"], r["rejected"]) == (n, prompt, c, j)
        assert [tuple(x) for x in r["chosen_spans"]] == cs and [tuple(x) for x in r["rejected_spans"]] == js


def test_conversations_ties_nulls_and_empty(spark):
    rows = [(1, 1, "assistant", "b", 9), (1, 0, "user", "a", 9), (1, 1, "assistant", "b", 9), (None, None, None, None, 9),
            (2, 0, "user", "q", 9), (3, 0, "assistant", "first", 9), (4, 0, "user", "q", 9), (4, 1, "assistant", "r", 9)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, turns int")
    got = {r["conv_id"]: [tuple(t) for t in r["turns"]] for r in p.conversation_turns(df).collect()}
    assert got[1] == [("user", "a"), ("assistant", "b"), ("assistant", "b")] and got[None] == [("unknown", "")]
    pairs = {r["conv_id"]: r for r in p.stale_answers(p.conversation_turns(df)).collect()}
    assert [t["text"] for t in pairs[1]["rejected"]] == ["a", "b", "b"] and pairs[2]["chosen"] == pairs[2]["rejected"]
    assert [t["text"] for t in pairs[3]["rejected"]] == [""] and [t["text"] for t in pairs[4]["rejected"]] == ["q", "q"]
    assert p.format_preferences(p.stale_answers(p.conversation_turns(df.limit(0)))).count() == 0


def test_main_path_runs_no_python(spark):
    plan = p.op10_preference_format(spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
    got = p.op10_preference_format(spark, "/root/testdata/sf0.001")
    assert got.where(~F.col("prompt").startswith("<|im_start|>")).count() == 0


def test_turns_behind_the_last_answer_are_kept(spark):
    rows = [(1, 0, "user", "q"), (1, 1, "assistant", "a"), (1, 2, "user", "thanks"), (1, 3, "user", None), (2, 0, "user", "q"), (3, 0, "assistant", "x")]
    pairs = p.stale_answers(p.conversation_turns(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")))
    later = {r["conv_id"]: [tuple(t) for t in r["later"]] for r in pairs.collect()}
    assert later == {1: [("user", "thanks"), ("user", "")], 2: [], 3: []}
    got = p.op10_preference_format(spark, "/root/testdata/sf0.01")
    convs = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")
    inside = got.select(sum((F.size(F.split(F.col(c), r"<\|im_start\|>")) - 1 for c in ("prompt", "chosen", "later")), F.lit(0)).alias("n"))
    assert inside.agg(F.sum("n")).first()[0] == convs.count() and got.agg(F.sum("later_turns")).first()[0] > 0
