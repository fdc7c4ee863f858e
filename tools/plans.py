"""Print the executed (final adaptive) plan of registered queries and a short
summary of what it contains: scans with their read schema and partition
filters, exchanges, reused exchanges, broadcast and sort-merge joins.

usage: python tools/plans.py [sf_dir] key [key ...] [--full]
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def summary(plan: str) -> dict:
    final = plan.split("== Initial Plan ==")[0]
    return {
        "scans": len(re.findall(r"FileScan parquet|Scan parquet", final)),
        "exchanges": len(re.findall(r"\bExchange hashpartitioning", final)),
        "reused_exchanges": final.count("ReusedExchange"),
        "broadcast_joins": final.count("BroadcastHashJoin"),
        "sort_merge_joins": final.count("SortMergeJoin"),
        "partition_filters": len(re.findall(r"PartitionFilters: \[[^\]]", final)),
    }


def main() -> None:
    args = [a for a in sys.argv[1:] if not a.startswith("--")]
    full = "--full" in sys.argv
    sf = args[0] if args and "/" in args[0] else "/root/testdata/sf0.1"
    keys = [a for a in args if "/" not in a]
    from cardwatch.config import build_session
    from cardwatch.plans.registry import queries
    spark = build_session("local[8]", shuffle_partitions=8)
    qs = queries()
    for key in keys:
        df = qs[key](spark, sf)
        df.collect() if key != "report_view_chain" else df.write.format("noop").mode(
            "overwrite").save()
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            df.explain()
        plan = buf.getvalue()
        print(key, summary(plan))
        if full:
            print(plan)


if __name__ == "__main__":
    main()
