import re

import pytest

from pylonflow.llm import quality as q

STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def brute(text):
    t = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    grams = [tuple(w[i:i + 5]) for i in range(len(w) - 4)]
    seen = {}
    for g in grams:
        seen[g] = seen.get(g, 0) + 1
    covered = {i + k for i, g in enumerate(grams) if seen[g] > 1 for k in range(5)}
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(covered))


@pytest.mark.parametrize("text", [None, "", " \n\t", "a b c d e", "a b c d e a b c d e", "x x x x x x", "one\n\none\n one \none",
                                  "A#b $ % é ß 漢字", "a\x0bb\x0cc\rd", "p q r s t u " * 40])
def test_statistics_match_brute_force(text):
    t = q.Text(None if text is None else text.encode())
    assert tuple(getattr(t, f) for f in STATS) == brute(text)


def test_window_codes_stay_exact_for_many_distinct_words():
    words = [f"w{i}" for i in range(9000)]
    text = " ".join(words + words[100:110])
    assert q.Text(text.encode()).n_repeat_words == brute(text)[4] == 20


def test_order_is_by_rejection_per_cost_and_does_not_change_verdicts(spark, odd_docs):
    rules = q.default_rules()
    costs = [{"rule": r.name, "rejects": 0.1 * (k + 1), "cost": 1.0 if k else 0.001} for k, r in enumerate(rules)]
    order = q.cascade_order(rules, costs)
    assert order[0] is rules[0] and [r.name for r in order[1:]] == [r.name for r in reversed(rules[1:])]
    verdict = [{(r["doc_id"], r["kept"]) for r in q.run_cascade(odd_docs, "text", o, ["doc_id"]).collect()}
               for o in (rules, rules[::-1], order)]
    assert verdict[0] == verdict[1] == verdict[2]


def test_odd_rows(spark, odd_docs, no_docs):
    got = q.quality_cascade(odd_docs, "text", ["doc_id"], STATS).collect()
    want = sorted(((r["doc_id"] or 0),) + brute(r["text"]) for r in odd_docs.collect())
    assert sorted(((r["doc_id"] or 0),) + tuple(r[f] for f in STATS) for r in got) == want
    assert all(not r["kept"] for r in got if r["base_failed"])
    assert {r["rejected_by"] for r in got if r["doc_id"] == 3} == {"too_short"}
    assert q.quality_cascade(no_docs, "text", ["doc_id"], STATS).count() == 0


def test_short_circuit_skips_later_rules():
    asked = []
    rules = [q.Rule("first", lambda t: True), q.Rule("second", lambda t: asked.append(1) or False)]
    first = next((r for r in rules if r.rejects(q.Text(b"x"))), None)
    assert first.name == "first" and not asked
