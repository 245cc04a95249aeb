"""Write PLANS.md: the shape of every registered query's final (AQE) plan.

usage: python tests/plan_report.py [sf_dir] > PLANS.md
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from hirelake.plans import catalog  # noqa: E402
from hirelake.session import local_session  # noqa: E402


def shape(plan: str) -> dict:
    # AQE prints the final plan first, then the initial one; keep the final.
    final = plan.split("+- == Initial Plan ==")[0]
    return {
        "shuffles": len(re.findall(r"Exchange (hashpartitioning|rangepartitioning|RoundRobinPartitioning|SinglePartition)", final)),
        "single": final.count("Exchange SinglePartition"),
        "broadcasts": final.count("BroadcastExchange"),
        "python": len(re.findall(r"(BatchEvalPython|ArrowEvalPython|MapInPandas|FlatMapGroupsInPandas)", final)),
        "scans": final.count("FileScan"),
        "pushed": len(re.findall(r"PushedFilters: \[[^\]]+\]", final)),
    }


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session(8, 8)
    print("# PLANS\n")
    print(f"Final adaptive plans of the registered queries at `{sf_dir}` (local[8], 8 shuffle partitions), "
          "read after they ran. shuffles = hash/range/round-robin/single exchanges; "
          "single = `Exchange SinglePartition` (each is listed with what it carries below); "
          "python = Python/pandas evaluation nodes; pushed = scans with non-empty PushedFilters. "
          "Queries that need the fact or the archive store it and read it back, as the daily build does; the "
          "plan shown is what follows the stored table.\n")
    print("| query | shuffles | single | broadcasts | python | scans | pushed |")
    print("|---|---|---|---|---|---|---|")
    notes = []
    import bench
    todo = [(n, (lambda q: lambda: q(spark, sf_dir))(q)) for n, q in catalog.QUERIES.items()]
    todo += list(bench.stages(spark, sf_dir).items())
    for name, build in todo:
        run = build()._jdf.queryExecution()
        run.toRdd().count()                       # this execution's own plan becomes final
        plan = run.executedPlan().toString()
        assert "AdaptiveSparkPlan" not in plan or "isFinalPlan=true" in plan, name
        s = shape(plan)
        print(f"| {name} | {s['shuffles']} | {s['single']} | {s['broadcasts']} | {s['python']} | "
              f"{s['scans']} | {s['pushed']} |")
        final = plan.split("+- == Initial Plan ==")[0].split("\n")
        for i, line in enumerate(final):
            if "Exchange SinglePartition" in line and i + 1 < len(final):
                child = re.sub(r"#\d+L?", "", final[i + 1].strip().lstrip("+- :"))[:110]
                notes.append(f"- `{name}`: single-partition exchange over `{child}`")
    print("\n## What each single-partition exchange carries\n")
    print("\n".join(sorted(set(notes))) or "none")
    spark.stop()


if __name__ == "__main__":
    main(sys.argv)
