"""Summarise the physical plans of the headline queries (Markdown table).

Usage: python scripts/plan_report.py [sf_dir]
Counts, per query, the shuffles, broadcasts, scans with pushed or
partition filters and Python stages of the final plan (the DataFrame each
query returns; writes a query performs before returning are not shown).
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from lumenflow.queries import all_queries  # noqa: E402
from lumenflow.session import build_session  # noqa: E402

HEADLINE = ("pos_segmentation_month", "previous_month_slice", "seed_month_filter", "diamond_check", "cdc_latest_by_key", "cdc_key_bounded_batch",
            "exact_match_split", "fuzzy_best_match", "address_merge", "upsert_existing",
            "hierarchy_flatten", "duplicate_check")


def summary(plan: str) -> dict[str, object]:
    scans = re.findall(r"\(\d+\) Scan parquet[^\n]*\n(?:[^\n]+\n)*?ReadSchema: ([^\n]+)", plan)
    return {
        "shuffles": len(re.findall(r"\) Exchange\n", plan)),
        "broadcasts": len(re.findall(r"\) BroadcastExchange\n", plan)),
        "scans": len(re.findall(r"\) Scan parquet", plan)),
        "pushed": len(re.findall(r"PushedFilters: \[[^\]]", plan)),
        "partition": len(re.findall(r"PartitionFilters: \[[^\]]", plan)),
        "python": len(re.findall(r"\) (ArrowEvalPython|FlatMapCoGroupsInPandas|FlatMapGroupsInPandas|MapInPandas)", plan)),
        "widest_read": max((s.count(":") for s in scans), default=0),
    }


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session()
    spark.sparkContext.setLogLevel("ERROR")
    qs = all_queries()
    print("| query | shuffles | broadcasts | parquet scans | with pushed filters | with partition filters | Python stages | widest ReadSchema (cols) |")
    print("| --- | --- | --- | --- | --- | --- | --- | --- |")
    for name in HEADLINE:
        df = qs[name](spark, sf_dir)
        plan = df._jdf.queryExecution().explainString(
            spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
        s = summary(plan)
        print(f"| {name} | {s['shuffles']} | {s['broadcasts']} | {s['scans']} | {s['pushed']} | "
              f"{s['partition']} | {s['python']} | {s['widest_read']} |")
    fuzzy_pairs(spark, sf_dir)


def fuzzy_pairs(spark, sf_dir: str) -> None:
    """Pairs of the blocks and pairs whose chunk is opened, at ``sf_dir`` and at
    ten times its rows."""
    from lumenflow.operators import matching
    from lumenflow.queries import address

    print("\n| data | pairs in the blocks | in opened chunks | share |")
    print("| --- | --- | --- | --- |")
    for path in (sf_dir, sf_dir.replace("sf0.01", "sf0.1")):
        report: dict = {}
        _, left, master = matching.exact_split(address._region(spark, path), address._master(spark, path))
        matching.fuzzy_best_match(left, master, address.BINDING_RULES, report=report)
        share = report["scored_pairs"] / max(report["block_pairs"], 1)
        print(f"| {os.path.basename(path)} | {report['block_pairs']} | {report['scored_pairs']} | {share:.0%} |")


if __name__ == "__main__":
    main()
