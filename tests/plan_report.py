"""Write PLANS.md: per registered query, what its physical plan does.

usage: python tests/plan_report.py [sf_dir]
Counts shuffles (Exchange), join strategies, aggregates, windows, pushed
scan filters and Python evaluation in the executed (pre-AQE) plan.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def summarize(plan: str) -> dict:
    lines = plan.splitlines()

    def count(pat):
        return sum(1 for ln in lines if re.search(pat, ln))
    joins = sorted({m.group(1) for ln in lines for m in [re.search(r"(BroadcastHashJoin|SortMergeJoin|"
                                                                   r"ShuffledHashJoin|BroadcastNestedLoopJoin|"
                                                                   r"CartesianProduct)", ln)] if m})
    pushed = sum(1 for ln in lines if "PushedFilters: [" in ln and "PushedFilters: []" not in ln)
    scans = count(r"FileScan|Scan ExistingRDD|LocalTableScan")
    return {
        "shuffles": count(r"Exchange (hashpartitioning|rangepartitioning|SinglePartition|RoundRobin)"),
        "broadcasts": count(r"BroadcastExchange"),
        "joins": ", ".join(joins) or "-",
        "aggregates": count(r"HashAggregate\(keys=.*functions=\[(?!.*partial_)"),
        "windows": count(r"^\s*[:+\- ]*Window \["),
        "scans": scans,
        "pushed": pushed,
        "python": "yes" if re.search(r"BatchEvalPython|ArrowEvalPython|PythonUDF|MapInPandas|MapInArrow|FlatMapGroupsInPandas", plan) else "no",
    }


def main(argv):
    import __spark_entry__ as E
    from wardlake.session import get_session

    sf = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    spark = get_session("local[8]", 8)
    spark.sparkContext.setLogLevel("ERROR")
    spark.conf.set("spark.sql.adaptive.enabled", "false")    # the static plan Catalyst chose
    rows = []
    for name, fn in sorted(E.queries().items()):
        df = fn(spark, sf)
        plan = df._jdf.queryExecution().executedPlan().toString()
        rows.append((name, summarize(plan)))
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    out = ["# PLANS", "",
           f"Static physical plans (AQE off, so the numbers show Catalyst's choice before runtime re-planning) "
           f"of every registered query at `{sf}`; generated by `tests/plan_report.py`. Queries that write "
           "files or run a stream first (readers, writers, streams, runs) show the plan of reading their "
           "result back.", "",
           "| query | shuffles | broadcasts | joins | final aggs | windows | scans | scans w/ pushed filters | python |",
           "|---|---|---|---|---|---|---|---|---|"]
    for name, s in rows:
        out.append(f"| {name} | {s['shuffles']} | {s['broadcasts']} | {s['joins']} | {s['aggregates']} | "
                   f"{s['windows']} | {s['scans']} | {s['pushed']} | {s['python']} |")
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md"), "w") as f:
        f.write("\n".join(out) + "\n")
    print(f"wrote {len(rows)} plans")


if __name__ == "__main__":
    main(sys.argv)
