"""Per report query: median wall time and plan shape (exchanges, broadcasts,
scans, sort-merge joins, bytes written to shuffles) after execution, at one scale.

usage: python tools/plan_stats.py [sf_dir] [repeat]
"""

from __future__ import annotations

import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from cxpulse.session import get_session  # noqa: E402
from cxpulse.testbed.queries import all_queries  # noqa: E402


def shape(df) -> dict[str, int]:
    plan = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    return {
        "exchanges": len(re.findall(r"\bExchange (hashpartitioning|SinglePartition|rangepartitioning)",
                                    plan)),
        "broadcasts": plan.count("BroadcastExchange"),
        "smj": plan.count("SortMergeJoin"),
        "scans": plan.count("FileScan parquet"),
        "shuffle_kb": _written(df._jdf.queryExecution().executedPlan()) // 1024,
    }


def _written(node) -> int:
    """Shuffle bytes written below a node of the executed plan."""
    name = node.getClass().getSimpleName()
    if name == "AdaptiveSparkPlanExec":
        return _written(node.executedPlan())
    if name.endswith("QueryStageExec"):
        return _written(node.plan())
    own = 0
    if name == "ShuffleExchangeExec":
        metric = node.metrics().get("shuffleBytesWritten")
        own = metric.get().value() if metric.isDefined() else 0
    children = node.children()
    return own + sum(_written(children.apply(i)) for i in range(children.size()))


def main(argv: list[str]) -> None:
    sf_dir = argv[0] if argv else "/root/testdata/sf0.1"
    repeat = int(argv[1]) if len(argv) > 1 else 5
    spark = get_session("local[8]", shuffle_partitions=8)
    qs = all_queries()
    for q in qs.values():
        q(spark, sf_dir).write.format("noop").mode("overwrite").save()
    print("| query | median s | exchanges | broadcasts | SMJ | scans | shuffle KB |")
    print("| --- | --- | --- | --- | --- | --- | --- |")
    for name, q in qs.items():
        ts = []
        for _ in range(repeat):
            t0 = time.perf_counter()
            df = q(spark, sf_dir)
            df.write.format("noop").mode("overwrite").save()
            ts.append(time.perf_counter() - t0)
        df.collect()  # the noop write has a plan of its own; the shape is read from this one
        s = shape(df)
        print(f"| {name} | {statistics.median(ts):.2f} | {s['exchanges']} | {s['broadcasts']} | "
              f"{s['smj']} | {s['scans']} | {s['shuffle_kb']} |")


if __name__ == "__main__":
    main(sys.argv[1:])
