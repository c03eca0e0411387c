"""Markdown table of the physical plan shape of the headline queries at a
scale factor (run on parquet extracts of the ERP sources, like bench.py)."""

import os
import re
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

COUNT = {
    "shuffles": r"Exchange hashpartitioning|Exchange rangepartitioning",
    "single-partition": r"Exchange SinglePartition",
    "broadcasts": r"BroadcastExchange",
    "SMJ": r"SortMergeJoin",
    "BHJ": r"BroadcastHashJoin",
    "windows": r"\bWindow \[",
    "codegen stages": r"\*\(\d+\)",
    "scans": r"FileScan parquet",
}


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    from bench import HEADLINE
    from martspark.catalog import QUERIES
    from martspark.session import local_session
    from martspark.sources.binding import materialize, use_extracts

    spark = local_session(8, 16)
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # static plan shape (AQE re-plans at run time)
    ext = tempfile.mkdtemp(prefix="martspark-plans-")
    materialize(spark, sf_dir, ext)
    use_extracts(spark, "X", ext)
    print("| query | " + " | ".join(COUNT) + " |")
    print("| --- |" + " --- |" * len(COUNT))
    for name in HEADLINE:
        plan = QUERIES[name](spark, "X")._jdf.queryExecution().executedPlan().toString()
        cells = [str(len(re.findall(p, plan))) for p in COUNT.values()]
        print(f"| `{name}` | " + " | ".join(cells) + " |", flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
