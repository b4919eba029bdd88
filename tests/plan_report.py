"""Plan shape of every registered query (static physical plan, AQE off).

``python tests/plan_report.py [/root/testdata/sf0.1] > PLANS.md`` writes a
markdown table: shuffles, join strategies, partial aggregations, windows and
any Python evaluation per query. AQE is disabled only so the printed plan is
the full static plan; at run time AQE may still coalesce partitions or turn
a sort-merge join into a broadcast join.
"""

from __future__ import annotations

import os
import re
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


def shape(plan: str) -> dict[str, int]:
    return {
        "shuffle": len(re.findall(r"Exchange (hashpartitioning|rangepartitioning|RoundRobin|SinglePartition)", plan)),
        "reused": plan.count("ReusedExchange"),
        "broadcast_join": plan.count("BroadcastHashJoin"),
        "semi_join": len(re.findall(r"LeftSemi", plan)),
        "sort_merge_join": plan.count("SortMergeJoin"),
        "partial_agg": len(re.findall(r"functions=\[partial_", plan)),
        "window": len(re.findall(r"\bWindow \[", plan)),
        "scans": plan.count("FileScan parquet"),
        "python": sum(plan.count(k) for k in ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas",
                                               "MapInPandas", "PythonUDF")),
        "cartesian": plan.count("CartesianProduct") + plan.count("BroadcastNestedLoopJoin"),
    }


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    from curbwise.session import get_spark
    from curbwise import registry
    spark = get_spark("local[8]", 16)
    spark.sparkContext.setLogLevel("ERROR")
    qs = registry.queries()
    rows = []
    for name in qs:
        df = qs[name](spark, sf)
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        try:
            plan = df._jdf.queryExecution().executedPlan().toString()
        finally:
            spark.conf.set("spark.sql.adaptive.enabled", "true")
        rows.append((name, shape(plan)))
    cols = list(rows[0][1])
    print(f"# Plan shapes ({os.path.basename(sf)}, static plans, AQE off for printing)\n")
    print("Generated by `python tests/plan_report.py`. Counts of physical operators per registered query.\n")
    print("| query | " + " | ".join(cols) + " |")
    print("| --- | " + " | ".join("---" for _ in cols) + " |")
    for name, s in rows:
        print(f"| {name} | " + " | ".join(str(s[c]) for c in cols) + " |")


if __name__ == "__main__":
    main()
