"""Plan report: what each registered query costs physically.

For every query the final (post-AQE) physical plan is summarised: scans and
what they read, exchanges by kind, joins, windows, Python nodes. Run
``python -m pylonflow.plans.report [sf_dir] > PLANS.md``.
"""

from __future__ import annotations

import re
import sys


def final_plan(df) -> str:
    df.write.format("noop").mode("overwrite").save()
    qe = df._jdf.queryExecution()
    plan = qe.executedPlan()
    try:
        return plan.finalPhysicalPlan().toString()
    except Exception:  # noqa: BLE001 - not adaptive
        return plan.toString()


_EXCHANGE = re.compile(r"(?<!Broadcast)Exchange (hashpartitioning|rangepartitioning)\(([^)]*)\)"
                       r"|(?<!Broadcast)Exchange (SinglePartition|RoundRobinPartitioning\(\d+\))|(BroadcastExchange)")
_READ = re.compile(r"ReadSchema: (struct<[^>]*>)")
_PUSHED = re.compile(r"PushedFilters: \[([^\]]*)\]")
_JOIN = re.compile(r"(BroadcastHashJoin|SortMergeJoin|ShuffledHashJoin|BroadcastNestedLoopJoin|CartesianProduct)"
                   r" \[([^\]]*)\], \[[^\]]*\], (\w+)")


def summarize(plan: str) -> dict:
    exchanges = []
    for m in _EXCHANGE.finditer(plan):
        if m.group(4):
            exchanges.append("broadcast (size-checked by AQE)")
        elif m.group(1):
            cols = ", ".join(re.sub(r"#\d+L?", "", c.strip()) for c in m.group(2).split(",")[:-1])
            exchanges.append(f"{m.group(1)}({cols})")
        else:
            exchanges.append(m.group(3))
    joins = [f"{m.group(1)} {m.group(3)} on [{re.sub(r'#[0-9]+L?', '', m.group(2))}]" for m in _JOIN.finditer(plan)]
    return {
        "scans": plan.count("FileScan") + plan.count("ScanRDD"),
        "read": sorted(set(_READ.findall(plan))),
        "pushed": sorted({p for p in _PUSHED.findall(plan) if p}),
        "exchanges": exchanges,
        "joins": joins,
        "windows": plan.count("Window ["),
        "python": sorted({n for n in ("MapInPandas", "ArrowEvalPython", "BatchEvalPython", "FlatMapGroupsInPandas")
                          if n in plan}),
        "partial_agg": "partial_" in plan,
        "top_n": "TakeOrderedAndProject" in plan,
    }


def main(sf_dir: str = "/root/testdata/sf0.01") -> None:
    import os
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))
    from pylonflow.plans.catalog import QUERIES
    from pylonflow.session import local_session

    spark = local_session(8)
    print("# PLANS\n")
    print(f"Final physical plans (AQE applied) of every core query at `{sf_dir}`, summarised by "
          "`python -m pylonflow.plans.report`. Streaming queries are summarised by the batch read of their "
          "sink, so only their batch twins are listed.\n")
    print("| Query | Scans | Exchanges | Joins | Windows | Python | Partial agg | Pushed filters / read schema |")
    print("|---|---|---|---|---|---|---|---|")
    for name, fn in QUERIES.items():
        if name.startswith("stream_"):
            continue
        s = summarize(final_plan(fn(spark, sf_dir)))
        rs = "; ".join(s["read"])
        pf = ("pushed: " + "; ".join(s["pushed"]) + "<br>") if s["pushed"] else ""
        print(f"| `{name}` | {s['scans']} | {'<br>'.join(s['exchanges']) or '-'} | {'<br>'.join(s['joins']) or '-'} "
              f"| {s['windows']} | {', '.join(s['python']) or '-'} | {'yes' if s['partial_agg'] else '-'} "
              f"| {pf}{rs} |")


if __name__ == "__main__":
    main(*sys.argv[1:])
