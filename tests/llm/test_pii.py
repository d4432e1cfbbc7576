import re

import pytest

from pylonflow.llm import pii


def brute(t):
    out = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t)
            if all(int(x) <= 255 for x in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        d = re.sub("[ -]", "", m[0])
        if 12 <= len(d) <= 19 and pii.luhn(d):
            out.append((m.start(), 2, m.end()))
    out += [(m.start(), 3, m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t)
            if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return sorted(out)


@pytest.mark.parametrize("t", [
    "", "a@b", "a@b.c", "a@b.c_d@e.f", "x@@y.z @q.r a@b..c", "é.a@b-c.de.", "a@b.c@d.e.f", "1.2.3.4 256.1.1.1 1.2.3.4.5.6.7.8 01.002.3.255",
    "4111 1111 1111 1111", "4111-1111-1111-1112 5500000000000004", "+1 (377) 555-0271 +12 +1(( +44.20.7946.0958x", "++49 30 901820 +1-2-3",
    "0" * 25, "1." * 9 + "1", "4111 1111 1111 1111.2.3.4 +4111111111111111", "٣٤٥ ＠ a＠b.c", "漢 a@b.co 漢 10.0.0.1 漢"])
def test_base_matches_the_plain_expressions(t):
    assert pii.base_spans(t) == brute(t)


def test_hostile_long_texts_take_linear_time():
    for t in ("a" * 300_000, "1" * 300_000, "a@" * 100_000, "1.2." * 80_000, "+1" + "(" * 300_000, "1 " * 150_000, "a." * 100_000 + "@"):
        pii.candidates(t, pii.base_spans(t))


def test_patterns_in_both_scans_agree(spark):
    text = "Please call  My\tnumber 5550100 now\nor my number 5550101 or MY Number 5550102"
    for at in (m.start() for m in re.finditer(r"55501", text)):
        assert len(pii.pattern_hashes(text, at)) == 3
    one = pii.pattern_hashes(text, text.index("5550101"))
    wanted = spark.createDataFrame([(h,) for h in one], "pattern long")
    df = spark.createDataFrame([(text,), (None,), ("",), ("my number",)], "text string")
    got = {r["pattern"]: r["total"] for r in pii._pattern_counts(df, "text", wanted).collect()}
    assert got == {one[0]: 3, one[1]: 3, one[2]: 2}
    assert pii.pattern_hashes("x:5550100", 2) == [] and pii.pattern_hashes("5550100", 0) == []


def test_high_confidence_patterns_discover_unseen_identifiers(spark, odd_docs, no_docs):
    rows = [(k, f"word{k} please reach us under hotline +4930{k:07d} for help {k % 3}") for k in range(20)]
    rows += [(100 + k, f"other{k} reach us under hotline 030/{k}555{k}12 for help") for k in range(3)]
    rows += [(200 + k, f"row{k} the serial 0305{k}5512 and the serial of box{k}") for k in range(9)]
    rows += [(300, "our desk has 030/05550 12 or later 030/0555012"), (301, None), (302, "")]
    df = spark.createDataFrame([(*r, "z") for r in rows], "doc_id long, text string, base string")
    got = {r["id"]: r for r in pii.find_pii(df).collect()}
    assert len(got) == len(rows)
    for k, t in rows:
        assert [tuple(s) for s in got[k]["base"]] == brute(t or "")
        if 100 <= k < 200:   # no country code: only the pattern gives them away
            assert [t[s["start"]:s["end"]] for s in got[k]["added"]] == [t.split()[5]]
        elif k < 300:
            assert got[k]["added"] == []
    # the same identifier elsewhere is known by now
    assert [rows[-3][1][s["start"]:s["end"]] for s in got[300]["added"]] == ["030/0555012"]
    assert pii.find_pii(odd_docs).count() == odd_docs.count() and pii.find_pii(no_docs).count() == 0


@pytest.mark.parametrize("t,want", [
    ("at 030 555 1234 now", {(3, "030 555 1234")}), ("at (555) 123-4567.", {(3, "(555) 123-4567"), (3, "123-4567")}),
    ("at (030 555 1234)", {(3, "030 555 1234")}), ("at 030 / 555 1234x", set()), ("at 030 / 555 1234", {(3, "030 / 555 1234")}),
    ("no 4111 1111 1111 1112 07", {(2, "4111 1111 1111 1112"), (3, "4111 1111")}), ("at 5551234 20 times", {(3, "5551234")}),
    ("by 2024. 555 1234", {(3, "555 1234")}), ("of 300.1.2.3 99", {(1, "300.1.2.3")}), ("b" * 150 + "@host", {(0, "b" * 150 + "@host")})])
def test_candidates_span_digit_groups_and_long_tokens(t, want):
    got = {(k, t[a:e]) for a, k, e in pii.candidates(t, pii.base_spans(t))}
    assert want <= got and (want or not got)
    starts = [(a, k) for a, k, _ in pii.candidates(t, pii.base_spans(t))]
    assert len(starts) == len(set(starts))


def test_undecided_candidates_do_not_count_against_a_pattern(spark):
    near = [f"030 555 {1000 + k}" for k in range(5)] + [f"(555) 123-{4000 + k}" for k in range(4)]
    rows = [(k, f"w{k} reach our hotline +4930{k:07d} now") for k in range(14)]
    rows += [(100 + k, f"v{k} reach our hotline {x} now") for k, x in enumerate(near)]   # 9 of 23
    cards = [f"4111 1111 1111 {k:04d}" for k in range(10_000)]
    good, bad = [c for c in cards if pii.luhn(c.replace(" ", ""))][:4], [c for c in cards if not pii.luhn(c.replace(" ", ""))][:4]
    rows += [(200 + k, f"u{k} the card number {x} was") for k, x in enumerate(good + bad)]
    # many plain words behind the pattern speak against it
    rows += [(300 + k, f"t{k} see some page {x} then") for k, x in enumerate([f"+4940{k:07d}" for k in range(4)] + [f"040 555 {k}777" for k in range(1, 5)] + ["one"] * 9)]
    # each round's discoveries introduce the next pattern: more than three rounds
    chain = [f"0999 {k}00{j}00" for k in range(1, 7) for j in range(3)]
    rows += [(400 + k, f"hotline {x} end") for k, x in enumerate(chain[:3])]
    for k in range(1, 6):
        rows += [(500 + 10 * k + j, f"step{k}x is {chain[3 * (k - 1) + j]} and") for j in range(3)]
        rows += [(600 + 10 * k + j, f"step{k}x is {chain[3 * k + j]} and") for j in range(3)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["id"]: {r["text"][s["start"]:s["end"]] for s in r["added"]} for r in pii.find_pii(df).withColumnRenamed("id", "doc_id")
           .join(df, "doc_id").withColumnRenamed("doc_id", "id").collect()}
    assert [got[100 + k] for k in range(len(near))] == [{x} for x in near]
    assert [got[204 + k] for k in range(4)] == [{x} for x in bad] and not any(got[200 + k] for k in range(4))
    assert not any(got[300 + k] for k in range(17))
    assert [got[600 + 50 + j] for j in range(3)] == [{x} for x in chain[15:18]]
