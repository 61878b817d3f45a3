"""Summarise the physical plan of every registered query.

Usage: python scripts/plan_report.py [sf_dir]
For each query: shuffle exchanges, broadcast exchanges, Parquet scans (and
how many carry pushed filters), Python stages (grouped pandas), window and
aggregate operators, sort-merge joins. Plans are the adaptive initial plans
(no execution), so broadcast choices reflect static size estimates.
"""

from __future__ import annotations

import os
import re
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from civicstat.plans.catalog import QUERIES  # noqa: E402
from civicstat.session import build_session  # noqa: E402

SKIP = {"risk_scores"}  # trains models while building (checkpoint); plan is a scan of the checkpoint


def plan_text(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = build_session("local[8]", shuffle_partitions=16)
    print("| query | shuffles | broadcasts | scans | scans w/ pushed filters | python stages | windows | SMJ |")
    print("|---|---|---|---|---|---|---|---|")
    for name, fn in QUERIES.items():
        if name in SKIP:
            continue
        p = plan_text(fn(spark, sf_dir))
        shuffles = len(re.findall(r"Exchange hashpartitioning|Exchange rangepartitioning|Exchange SinglePartition|Exchange RoundRobin", p))
        bcast = p.count("BroadcastExchange")
        scans = re.findall(r"FileScan parquet[^\n]*", p)
        pushed = sum(1 for s in scans if "PushedFilters: [" in s and "PushedFilters: []" not in s)
        py = len(re.findall(r"FlatMapGroupsInPandas|FlatMapCoGroupsInPandas|ArrowEvalPython|BatchEvalPython", p))
        win = len(re.findall(r"\bWindow\b|WindowGroupLimit", p))
        smj = p.count("SortMergeJoin")
        print(f"| {name} | {shuffles} | {bcast} | {len(scans)} | {pushed} | {py} | {win} | {smj} |")
    spark.stop()


if __name__ == "__main__":
    main()
