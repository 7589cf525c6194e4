"""Summarise the physical plan of every named query (joins, shuffles, broadcasts, scans) as Markdown.

usage: python tools/plan_report.py [sf_dir] > PLANS.md
Two shapes per query: as planned at ``sf_dir``, and "at scale", with Spark's own size-estimate
broadcasts turned off, which is what big inputs get.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from addrflow.session import local_session  # noqa: E402

OPS = ("SortMergeJoin", "BroadcastHashJoin", "ShuffledHashJoin", "BroadcastNestedLoopJoin", "CartesianProduct")


def summary(df) -> dict:
    plan = df._jdf.queryExecution().executedPlan().toString()
    joins = {op: plan.count(op) for op in OPS if plan.count(op)}
    shuffles = len(re.findall(r"Exchange (hashpartitioning|SinglePartition|rangepartitioning)", plan))
    spreads = len(re.findall(r"Exchange RoundRobinPartitioning", plan))
    broadcasts = plan.count("BroadcastExchange")
    python = any(x in plan for x in ("PythonUDF", "BatchEvalPython", "ArrowEvalPython"))
    scans = []
    for line in plan.splitlines():
        m = re.search(r"FileScan parquet \[([^\]]*)\]", line)
        if m:
            table = re.search(r"/([a-z_]+)\.parquet", line)
            pushed = re.search(r"PushedFilters: \[(.*?)(?:\]|\.\.\.)", line)
            ncols = len([c for c in m.group(1).split(",") if c])
            scans.append((table.group(1) if table else "?", ncols, (pushed.group(1) if pushed else "")[:160]))
    return {"joins": joins, "shuffles": shuffles, "spreads": spreads, "broadcasts": broadcasts, "python": python, "scans": scans}


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    from addrflow.plans import queries as Q

    spark = local_session(shuffle_partitions=16)
    print(f"# Physical plans of the named queries ({os.path.basename(sf_dir)})\n")
    print("Generated by `tools/plan_report.py`. *At scale* = Spark's size-estimate broadcasts off")
    print("(`spark.sql.autoBroadcastJoinThreshold=-1`).\n")
    print("*Shuffles* counts hash/single-partition exchanges; *spreads* are the round-robin steps that")
    print("the test adapter adds because these tables are single-split files (`spread_over_cores`).\n")
    print("Joins carry no hints. `tests/test_skew.py` checks that AQE splits a hot tenant, delivery")
    print("address, sale order, key path and pincode.\n")
    print("| query | joins (as planned) | joins (at scale) | shuffles (at scale) | spreads | broadcasts (at scale) | Python |")
    print("|---|---|---|---|---|---|---|")
    details = []
    for name, fn in Q.queries().items():
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        here = summary(fn(spark, sf_dir))
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        big = summary(fn(spark, sf_dir))
        j = lambda d: ", ".join(f"{k}×{v}" for k, v in d.items()) or "–"
        print(f"| `{name}` | {j(here['joins'])} | {j(big['joins'])} | {big['shuffles']} | {big['spreads']} | {big['broadcasts']} | {'yes' if big['python'] else 'no'} |")
        details.append((name, big["scans"]))
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    print("\n## Scans (at scale): table, columns read, pushed filters\n")
    for name, scans in details:
        print(f"* `{name}`: " + "; ".join(f"{t} ({n} cols) [{f}]" for t, n, f in scans))
    spark.stop()


if __name__ == "__main__":
    main()
