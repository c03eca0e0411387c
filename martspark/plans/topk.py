"""Top-k rows per group without sending a hot group to one task.

A plain ``row_number() over (partition by key order by ...)`` sorts every row of
a key in one task; if one customer holds a third of all lines, that task does a
third of the work.  Two phases bound it:

1. rows are spread over ``salt_buckets`` sub-groups per key (hash of a column
   that varies within the key) and each sub-group keeps its own top k;
2. the survivors (≤ k × salt_buckets per key) are ranked again per key.

Both phases are exact: any row in the global top k of its key is in the top k
of its sub-group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_k_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int,
                    salt_cols: Sequence[str], salt_buckets: int = 32, rank_col: str = "rank") -> DataFrame:
    """Keep the first ``k`` rows of each ``keys`` group in ``order`` (a total order)."""
    salt = F.pmod(F.xxhash64(*salt_cols), F.lit(salt_buckets))
    w1 = Window.partitionBy(*keys, "_salt").orderBy(*order)
    stage1 = (df.withColumn("_salt", salt).withColumn("_r1", F.row_number().over(w1))
              .where(F.col("_r1") <= k))
    w2 = Window.partitionBy(*keys).orderBy(*order)
    return (stage1.drop("_salt", "_r1").withColumn(rank_col, F.row_number().over(w2))
            .where(F.col(rank_col) <= k))
