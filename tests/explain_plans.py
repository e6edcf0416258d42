"""Print the physical plans of registered queries (plan review helper).

Usage: python tests/explain_plans.py [sf_dir] name [name ...]
Prints, per query, the scans' ReadSchema and PushedFilters, the number of
exchanges and broadcast exchanges, and the formatted plan.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def summary(plan: str) -> dict:
    return {
        "exchanges": len(re.findall(r"Exchange hashpartitioning|Exchange rangepartitioning|Exchange SinglePartition|"
                                    r"Exchange RoundRobinPartitioning", plan)),
        "broadcasts": plan.count("BroadcastExchange"),
        "scans": re.findall(r"ReadSchema: (struct<[^\n]*>)", plan),
        "pushed": re.findall(r"PushedFilters: (\[[^\n]*\])", plan),
    }


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 and argv[1].startswith("/") else "/root/testdata/sf0.1"
    names = [a for a in argv[1:] if not a.startswith("/") and not a.startswith("--")]
    markdown = "--md" in argv
    from sparksweep.plans import registry
    from sparksweep.session import local_session
    spark = local_session()
    registry.load_all()
    if "--all" in argv:
        names = [n for n in sorted(registry.QUERIES) if not n.startswith("str")]
    if markdown:
        print("| Query | Exchanges | Broadcasts | Scans (read schema) | Pushed filters |")
        print("|---|---|---|---|---|")
    for n in names:
        df = registry.QUERIES[n](spark, sf_dir)
        plan = df._jdf.queryExecution().executedPlan().toString()
        s = summary(plan)
        if markdown:
            scans = "<br>".join(sorted(set(x.replace("struct<", "").rstrip(">")[:90] for x in s["scans"]))) or "(checkpoint)"
            pushed = "<br>".join(sorted(set(p for p in s["pushed"] if p != "[]"))) or "-"
            print(f"| `{n}` | {s['exchanges']} | {s['broadcasts']} | {scans} | {pushed[:160]} |", flush=True)
            continue
        print(f"== {n}: {s['exchanges']} exchanges, {s['broadcasts']} broadcasts")
        for sc in s["scans"]:
            print("   scan", sc[:160])
        for p in s["pushed"]:
            print("   pushed", p[:160])
    spark.stop()


if __name__ == "__main__":
    main(sys.argv)
