"""Plan shape per catalogue query, as a markdown table: exchanges by kind,
join strategies, JSON parses, Python stages, file scans (final adaptive
plan after one run).  ``FULL=1`` also prints every plan."""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from plait.plans import QUERIES  # noqa: E402
from plait.session import local_session  # noqa: E402


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    only = sys.argv[2] if len(sys.argv) > 2 else None
    spark = local_session(8, 16)
    print("| query | hash exch. | range exch. | round-robin | broadcast | SMJ | BHJ | windows | from_json | python | scans |")
    print("| --- | --- | --- | --- | --- | --- | --- | --- | --- | --- | --- |")
    for name, fn in QUERIES.items():
        if only and not re.search(only, name):
            continue
        df = fn(spark, sf_dir)
        df.write.format("noop").mode("overwrite").save()
        plan = df._jdf.queryExecution().executedPlan().toString()
        n = lambda pat: len(re.findall(pat, plan))
        print(f"| {name} | {n(r'Exchange hashpartitioning')} | {n(r'Exchange rangepartitioning')} | "
              f"{n(r'Exchange RoundRobin')} | {n(r'BroadcastExchange')} | {n(r'SortMergeJoin')} | "
              f"{n(r'BroadcastHashJoin')} | {n(r'Window \[')} | {n(r'from_json')} | "
              f"{n(r'MapInPandas|PythonUDF|ArrowEvalPython')} | {n(r'FileScan|InMemoryTableScan')} |")
        if os.environ.get("FULL"):
            print(plan)


if __name__ == "__main__":
    main()
