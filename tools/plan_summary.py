"""Summarise the executed physical plan of registered queries.

usage: python tools/plan_summary.py [sf_dir] [name ...]
For each query: shuffles (Exchange), broadcasts, reused exchanges, sorts,
windows, Python stages (ArrowEval/FlatMapGroupsInPandas/MapInPandas), and the
scan read schemas / pushed filters.  Each query is collected once (a dev
tool for small scale factors) so its own final adaptive plan is shown.
"""
from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def summarise(df) -> dict:
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    final = plan.split("== Initial Plan ==")[0]  # adaptive plans print both
    count = lambda pat: len(re.findall(pat, final))
    return {
        "shuffles": count(r"ShuffleQueryStage") or count(r"Exchange (hash|range|Single|Round)"),
        "broadcasts": count(r"BroadcastQueryStage") or count(r"BroadcastExchange"),
        "reused": count(r"ReusedExchange"),
        "single_partition": count(r"SinglePartition"),
        "python": count(r"ArrowEvalPython|FlatMapGroupsInPandas|MapInPandas"),
        "scans": sorted(set(re.findall(r"ReadSchema: (struct<[^>]*>)", final))),
    }


def main():
    args = sys.argv[1:]
    sf_dir = args[0] if args and os.path.isdir(args[0]) else "/root/testdata/sf0.01"
    names = [a for a in args if not os.path.isdir(a)]
    from velocube.catalog import QUERIES
    from velocube.session import get_spark
    spark = get_spark("local[8]", 8)
    for n in names or list(QUERIES):
        try:
            s = summarise(QUERIES[n](spark, sf_dir))
        except Exception as e:  # noqa: BLE001
            print(f"{n}: error {str(e)[:120]}")
            continue
        print(f"{n}: shuffles={s['shuffles']} broadcasts={s['broadcasts']} reused={s['reused']} "
              f"single_partition={s['single_partition']} python={s['python']} scans={s['scans']}")


if __name__ == "__main__":
    main()
