"""Write the final (post-AQE) physical plans of the headline queries to
docs/PLANS.md, keeping the operator lines (exchanges, joins, aggregates,
windows, scans with their pushed filters and read schema).

usage: python tools/plans.py [sf_dir]
"""

from __future__ import annotations

import os
import re
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from trendflow import catalog  # noqa: E402
from trendflow.session import local_session  # noqa: E402

QUERIES = ["dedup_latest", "category_lookup_join", "trending_analytics", "channel_analytics",
           "channel_top_k", "category_analytics", "dq_report", "reference_explode"]
KEEP = re.compile(r"Exchange|Join|Aggregate|Window|Expand|Scan|InMemory|Union|Sort \[|"
                  r"PushedFilters|PartitionFilters|ReadSchema|QueryStage")


def trimmed(plan: str) -> str:
    out = []
    final = plan.split("+- == Initial Plan ==")[0]
    for line in final.splitlines():
        if KEEP.search(line):
            line = re.sub(r"#\d+L?", "", line)
            out.append(line[:220])
    return "\n".join(out)


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session(8)
    parts = ["# Physical plans (final AQE plans, operator lines only)\n",
             f"Generated by `python tools/plans.py {sf_dir}` on local[8], 8 shuffle partitions.\n",
             "What to look for:\n\n"
             "* D1: a `WindowGroupLimit` *below* the `hashpartitioning(video_id, region, "
             "trending_date_parsed)` exchange (partial top-1 per map task), a final one above it.\n"
             "* J1: `BroadcastHashJoin LeftOuter BuildRight` on (category_id, region); the "
             "statistics side is not shuffled for the join.\n"
             "* A1: `Expand` + partial `HashAggregate` before each exchange (two distinct counts).\n"
             "* A2: four-phase `HashAggregate` for the distinct video count, the category set as a "
             "separate distinct branch, one regroup (`Union`) over aggregated rows.\n"
             "* W2: `hashpartitioning` on (region, magnitude, views, first letters of the channel), so a region is "
             "spread over all tasks; the offsets come from counted ranges; top-k uses `WindowGroupLimit`.\n"
             ]
    for name in QUERIES:
        df = catalog.QUERIES[name](spark, sf_dir)
        df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString()
        parts.append(f"## {name}\n\n{(catalog.QUERIES[name].__doc__ or '').strip()}\n\n```\n"
                     f"{trimmed(plan)}\n```\n")
    # Gold job variant of A1 (input materialised as Silver Parquet in a real
    # run): metrics and the two distinct sets as separate branches.
    from trendflow.plans.gold import build_gold
    from trendflow.sources import tables as src
    gold = build_gold(catalog.silver_view(spark, sf_dir), src.category_lookup_view(spark, sf_dir))
    df = gold["trending_analytics"]
    df.collect()
    parts.append("## trending_analytics, Gold-job variant (split distinct branches)\n\n```\n"
                 f"{trimmed(df._jdf.queryExecution().executedPlan().toString())}\n```\n")
    os.makedirs(os.path.join(ROOT, "docs"), exist_ok=True)
    with open(os.path.join(ROOT, "docs", "PLANS.md"), "w") as fh:
        fh.write("\n".join(parts))
    spark.stop()


if __name__ == "__main__":
    main()
