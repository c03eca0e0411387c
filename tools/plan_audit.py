"""Print the physical operators of every registered query (planning only,
except queries whose builders checkpoint eagerly)."""

import os
import re
import sys
from collections import Counter

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

NODES = ("BroadcastHashJoin", "SortMergeJoin", "ShuffledHashJoin", "BroadcastNestedLoopJoin", "CartesianProduct",
         "Exchange SinglePartition", "Window", "BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas",
         "Generate", "Expand", "Subquery", "TakeOrderedAndProject")


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    pats = sys.argv[2:]
    from martspark.catalog import QUERIES
    from martspark.session import local_session
    spark = local_session(4)
    for name, fn in QUERIES.items():
        if pats and not any(p in name for p in pats):
            continue
        plan = fn(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        c = Counter()
        for n in NODES:
            c[n] = len(re.findall(re.escape(n), plan))
        print(f"{name:36s} " + " ".join(f"{k.split()[-1][:14]}={v}" for k, v in c.items() if v))
    spark.stop()


if __name__ == "__main__":
    main()
