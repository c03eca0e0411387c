"""Broadcast only what has a proven size bound.

Two kinds of small sides appear in the marts:

* **Structurally bounded** frames whose row count cannot grow with the facts:
  a calendar generated from a date span (≤ 366 rows per year), one row per
  month present, a one-row total, the handful of aging buckets.  These are
  hinted with ``bounded()``; the bound is stated at each call site.
* **Master data** (customers, items, salespeople, territories) grows with the
  business.  ``small()`` hints a broadcast only when the optimizer's own size
  estimate of the (already pruned and filtered) plan is under the limit;
  otherwise the join is left to the planner and AQE, which re-plans at run time
  from real shuffle sizes (broadcast conversion, skew-join splitting).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Hard ceiling for an explicit broadcast hint on master data, in bytes of the files
# that Catalyst estimates from (rows of well-compressed keys take 40 times as much and
# more in the hash table that the driver builds).  Several hints may stack in one
# query, so it is low.
MAX_BROADCAST_BYTES = 256 * 1024
_FACTOR = "spark.sql.sources.fileCompressionFactor"


def estimated_bytes(df: DataFrame) -> int | None:
    """Catalyst's size estimate of the optimized plan (no job is run)."""
    try:
        stats = df._jdf.queryExecution().optimizedPlan().stats()
        return int(str(stats.sizeInBytes()))
    except Exception:  # pragma: no cover - remote sessions have no JVM handle
        return None


def small(df: DataFrame, limit: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """Broadcast hint only when the estimated size is known and under ``limit``."""
    size = estimated_bytes(df)
    if size is not None and size <= limit * float(df.sparkSession.conf.get(_FACTOR)):
        return F.broadcast(df)
    return df


def bounded(df: DataFrame) -> DataFrame:
    """Broadcast a frame whose row count is bounded by construction."""
    return F.broadcast(df)
