"""Write PLANS.md: the executed physical plan outline of every catalog query.

Usage: python tools/plans.py [sf_dir]
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidemark.plans.catalog import QUERIES  # noqa: E402
from tidemark.session import local_session  # noqa: E402

KEEP = re.compile(r"(Exchange|Window|HashAggregate|SortAggregate|ObjectHashAggregate|Join|Scan|Generate|"
                  r"BroadcastExchange|Filter|Union|Expand|AQEShuffleRead)")


def outline(plan: str) -> list[str]:
    out = []
    for line in plan.splitlines():
        if KEEP.search(line):
            line = re.sub(r"#\d+L?", "", line)
            line = re.sub(r", \[plan_id=\d+\]", "", line)
            out.append(line[:200])
    return out


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = local_session(8, shuffle_partitions=16)
    parts = ["# Physical plans\n", f"Executed plans (after adaptive execution) at `{sf}`, local[8], "
             "16 shuffle partitions.  Only exchanges, aggregates, windows, joins, generators, "
             "filters and scans are shown.\n"]
    for name, fn in QUERIES.items():
        df = fn(spark, sf)
        df.write.format("noop").mode("overwrite").save()
        plan = df._jdf.queryExecution().executedPlan().toString()
        n_ex = len(re.findall(r"Exchange hashpartitioning|Exchange rangepartitioning|Exchange SinglePartition", plan))
        parts.append(f"\n## {name}\n\nshuffle exchanges: {n_ex}\n\n```\n" + "\n".join(outline(plan)) + "\n```\n")
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md"), "w") as f:
        f.write("".join(parts))
    spark.stop()


if __name__ == "__main__":
    main()
