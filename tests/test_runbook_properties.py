"""The runbook parser against an independent character-level model of its
rules, on generated texts full of awkward whitespace and labels."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from pylonflow import parse_runbook
from pylonflow.schemas import PARSED_FIELDS

# JavaScript-style blanks and line terminators.
BLANKS = set("\t\n\x0b\x0c\r \u00a0\u1680" + "".join(chr(c) for c in range(0x2000, 0x200B))
             + "\u2028\u2029\u202f\u205f\u3000\ufeff")
TERMINATORS = set("\n\r\u2028\u2029")


def js_trim(s: str) -> str:
    i, j = 0, len(s)
    while i < j and s[i] in BLANKS:
        i += 1
    while j > i and s[j - 1] in BLANKS:
        j -= 1
    return s[i:j]


def value_after(line: str, label_len: int) -> str | None:
    rest = line[label_len:]
    k = 0
    while k < len(rest) and rest[k] in BLANKS:
        k += 1
    end = k
    while end < len(rest) and rest[end] not in TERMINATORS:
        end += 1
    return js_trim(rest[k:end]) if end > k else None


def action_label_len(line: str) -> int | None:
    if line[:6].upper() != "ACTION":
        return None
    k = 6
    while k < len(line) and line[k] in "0123456789":
        k += 1
    return k + 1 if k > 6 and k < len(line) and line[k] == ":" else None


def model(raw):
    if not raw:
        return (None,) * 5
    lines = [t for t in (js_trim(x) for x in raw.split("\n")) if t]
    out = {"SEVERITY": None, "DIAGNOSIS": None, "ESCALATION": None, "TICKET": None}
    actions = []
    for line in lines:
        for label in out:
            if line[:len(label) + 1].upper() == label + ":":
                v = value_after(line, len(label) + 1)
                if v is not None:
                    out[label] = v
        n = action_label_len(line)
        if n is not None:
            v = value_after(line, n)
            if v is not None:
                actions.append(v)
    up = lambda s: s.upper() if s is not None else None
    acts = "\n".join(f"{i + 1}. {a}" for i, a in enumerate(actions)) if actions else None
    return (up(out["SEVERITY"]), out["DIAGNOSIS"], acts, out["ESCALATION"], up(out["TICKET"]))


PIECES = ["SEVERITY:", "severity:", "Diagnosis:", "DIAGNOSIS:", "ACTION1:", "action22:", "ACTION:", "ESCALATION:",
          "TICKET:", "ticket:", "high", "P1", "fan fail", "x", ":", " ", "  ", "\t", "\r", "\u00a0", "\ufeff",
          "\u2028", "\n", "\n", "\n", "see ", "7"]
texts = st.one_of(st.none(), st.lists(st.sampled_from(PIECES), max_size=25).map("".join))


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(texts, min_size=1, max_size=40))
def test_parser_matches_rule_model(spark, batch):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(batch)], "id int, agent_response string")
    got = {r.id: tuple(r[f] for f in PARSED_FIELDS) for r in parse_runbook(df).collect()}
    for i, t in enumerate(batch):
        assert got[i] == model(t), repr(t)
