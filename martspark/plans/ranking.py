"""Global row numbers, ``ntile`` and exact medians without a single-task window.

``Window.orderBy(x)`` with no partition key moves every row into one task.  The
plan here (SURVEY D6) keeps the sort distributed:

1. range-partition and sort by the ordering (plus a unique tie-break key),
2. tag each row with its partition id and its position inside the partition
   (``monotonically_increasing_id`` is ``partition_id << 33 | position``),
3. count rows per partition (one row per partition, broadcast) and turn the
   counts into offsets with a window over those few rows,
4. global row number = offset + position + 1.

The range-partitioned frame is written once to the shared checkpoint folder
(``plans.stage``) with its partition id and position as columns, so the counts
and the rows see exactly the same numbering even if an executor is lost and
tasks are retried; range bounds come from sampling, so a plain recomputation
could move rows between partitions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .broadcast import bounded
from .stage import stage

_POS_MASK = (1 << 33) - 1


def global_row_number(df: DataFrame, order: Sequence[Column], out: str = "row_number",
                      num_partitions: int | None = None) -> DataFrame:
    """Add ``out`` = 1-based position of each row in ``order`` (must be a total order)."""
    spark = df.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    # partition id and position are stored as columns, so the staged copy can
    # be read back with any file split and still give the same numbering
    ranged = stage(df.repartitionByRange(n, *order).sortWithinPartitions(*order)
                   .select("*", F.spark_partition_id().alias("_pid"),
                           (F.monotonically_increasing_id().bitwiseAND(F.lit(_POS_MASK))).alias("_pos")),
                   "ranked")
    counts = ranged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_cnt"))
    # one row per partition: an unpartitioned window over it is bounded by the partition count
    w = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = bounded(counts.select("_pid", F.coalesce(F.sum("_cnt").over(w), F.lit(0)).alias("_off"),
                                    F.sum("_cnt").over(Window.partitionBy()).alias("_total")))
    j = ranged.join(offsets, "_pid")
    return j.select(*[F.col(f"`{c}`") for c in df.columns],
                    (F.col("_off") + F.col("_pos") + 1).alias(out),
                    F.col("_total").alias(f"{out}_total"))


def keyed_row_number(df: DataFrame, keys: Sequence[str], order: Sequence[Column], out: str = "row_number",
                     num_partitions: int | None = None) -> DataFrame:
    """Add ``out`` = ``row_number() over (partition by keys order by order)``
    without sorting one key's rows in one task.

    A window partitioned by ``keys`` puts every row of a key into one task, so a
    key holding a third of the rows holds a third of the work.  Here the rows
    are range-partitioned by (keys, order) and staged with their partition id;
    a hot key is then cut into pieces over many range partitions.  Rows are
    numbered inside each (key, partition) piece by a window partitioned by
    (keys, partition id) — no piece is larger than one range partition — and
    each piece adds the number of the key's rows in earlier partitions.  Only
    the first key of a partition can continue from an earlier one, so at most
    one offset per partition is non-zero: that table is bounded by the
    partition count and broadcast.  ``order`` must refer to columns by name
    and should be a total order within a key (rows equal in it are numbered
    in an arbitrary order, as with the window).
    """
    spark = df.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = stage(df.repartitionByRange(n, *[F.col(k).asc() for k in keys], *order)
                   .select("*", F.spark_partition_id().alias("_pid")), "keyed")
    # one row per (key, partition) piece, partial-aggregated before the shuffle;
    # a key has at most one piece per partition, so each window group is bounded
    pieces = ranged.groupBy(*keys, "_pid").agg(F.count(F.lit(1)).alias("_cnt"))
    before = Window.partitionBy(*keys).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (pieces.select(*[F.col(k).alias(f"_o_{k}") for k in keys], F.col("_pid").alias("_o_pid"),
                             F.sum("_cnt").over(before).alias("_off"))
               .where(F.col("_off").isNotNull()))
    # at most one row per range partition (its first key, when continued)
    offsets = bounded(offsets)
    cond = F.col("_pid") == F.col("_o_pid")
    for k in keys:
        cond = cond & F.col(k).eqNullSafe(F.col(f"_o_{k}"))
    j = ranged.join(offsets, cond, "left")
    w = Window.partitionBy(*keys, "_pid").orderBy(*order)
    return j.select(*[F.col(f"`{c}`") for c in df.columns],
                    (F.row_number().over(w) + F.coalesce(F.col("_off"), F.lit(0))).alias(out))


def keyed_running_sum(df: DataFrame, keys: Sequence[str], order: Sequence[Column], value: str, out: str,
                      num_partitions: int | None = None) -> DataFrame:
    """Add ``out`` = ``sum(value) over (partition by keys order by order)`` up to and with the row, without one
    task for a key: the sums inside the pieces of ``keyed_row_number`` plus the sum of the key's earlier pieces.
    ``order`` should be a total order within a key."""
    n = num_partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = stage(df.repartitionByRange(n, *[F.col(k).asc() for k in keys], *order)
                   .select("*", F.spark_partition_id().alias("_pid")), "keyed")
    pieces = ranged.groupBy(*keys, "_pid").agg(F.sum(value).alias("_sum"))
    before = Window.partitionBy(*keys).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    # at most one row per range partition (its first key, when continued)
    offsets = bounded(pieces.select(*[F.col(k).alias(f"_o_{k}") for k in keys], F.col("_pid").alias("_o_pid"),
                                    F.sum("_sum").over(before).alias("_off")).where(F.col("_off").isNotNull()))
    cond = F.col("_pid") == F.col("_o_pid")
    for k in keys:
        cond = cond & F.col(k).eqNullSafe(F.col(f"_o_{k}"))
    inside = Window.partitionBy(*keys, "_pid").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return ranged.join(offsets, cond, "left").select(
        *[F.col(f"`{c}`") for c in df.columns],
        (F.sum(value).over(inside) + F.coalesce(F.col("_off"), F.lit(0))).alias(out))


def bucketed_row_number(df: DataFrame, keys: Sequence[Column], order: Sequence[str], out: str) -> DataFrame:
    """Add ``out`` = ``row_number() over (partition by keys order by order)``, as a lazy plan.

    The first order column cuts a key into pieces: rows are numbered inside each
    (key, value) piece, and a piece starts after the key's rows with smaller
    values, a running sum over one row per (key, value).  So a key with very many
    rows is only gathered as its distinct first values.  Nothing is staged and no
    job runs while the plan is built.
    """
    names = [f"_k{i}" for i in range(len(keys))]
    first = order[0]
    d = df.select("*", *[k.alias(n) for k, n in zip(keys, names, strict=True)])
    counts = d.groupBy(*names, first).agg(F.count(F.lit(1)).alias("_cnt"))
    before = Window.partitionBy(*names).orderBy(first).rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(*[F.col(n).alias(f"_o{n}") for n in names], F.col(first).alias("_of"),
                           F.coalesce(F.sum("_cnt").over(before), F.lit(0)).alias("_off"))
    cond = F.col(first).eqNullSafe(F.col("_of"))
    for n in names:
        cond = cond & F.col(n).eqNullSafe(F.col(f"_o{n}"))
    inside = Window.partitionBy(*names, first).orderBy(*order)
    numbered = d.select("*", F.row_number().over(inside).alias("_in"))
    return numbered.join(starts, cond).select(*[F.col(f"`{c}`") for c in df.columns],
                                              (F.col("_in") + F.col("_off")).alias(out))


def clustered_row_number(df: DataFrame, cluster: Sequence[Column], keys: Sequence[Column], order: Sequence[str],
                         out: str) -> DataFrame:
    """Add ``out`` = ``row_number() over (partition by keys order by order)`` to rows that are partitioned by
    ``cluster``, which ``keys`` determine: no shuffle.  A cluster's rows meet in one task, sorted with spilling."""
    return df.select("*", F.row_number().over(Window.partitionBy(*cluster, *keys).orderBy(*order)).alias(out))


def ntile_from_rank(r: Column, n: Column, buckets: int) -> Column:
    """SQL ``ntile(buckets)`` of the row at 1-based position ``r`` among ``n`` rows."""
    q = (n / buckets).cast("bigint")
    rem = n % buckets
    big = rem * (q + 1)
    return (F.when(r <= big, ((r - 1) / (q + 1)).cast("bigint") + 1)
            .otherwise(rem + ((r - big - 1) / F.nullif(q, F.lit(0))).cast("bigint") + 1)).cast("int")


def global_ntile(df: DataFrame, order: Sequence[Column], buckets: int, out: str) -> DataFrame:
    """Add ``out`` = ``ntile(buckets) over (order by <order>)`` computed distributed."""
    ranked = global_row_number(df, order, "_rn")
    return ranked.select(*[F.col(f"`{c}`") for c in df.columns],
                         ntile_from_rank(F.col("_rn"), F.col("_rn_total"), buckets).alias(out))


def global_median(df: DataFrame, value: str, tie_key: str) -> DataFrame:
    """One-row frame with the exact (interpolated) median of ``value``.

    The two middle rows are picked by global row number; no task ever holds
    more than its range partition.
    """
    ranked = global_row_number(df.where(F.col(value).isNotNull()).select(value, tie_key),
                               [F.col(value).asc(), F.col(tie_key).asc()], "_rn")
    lo = F.floor((F.col("_rn_total") + 1) / 2)
    hi = F.ceil((F.col("_rn_total") + 1) / 2)
    mid = ranked.where((F.col("_rn") == lo) | (F.col("_rn") == hi))
    return mid.agg(F.avg(F.col(value).cast("double")).alias(f"{value}_median"))


def global_ntiles(df: DataFrame, key: str, specs: Sequence[tuple[str, str, bool]], buckets: int) -> DataFrame:
    """Several global ``ntile`` scores in one distributed sort.

    ``specs`` = (output column, value column, descending).  The rows are stacked
    once per spec (spec id first in the sort key, each spec's value in its own
    column, ``key`` ascending as tie-break), numbered with one range sort, and
    pivoted back to one row per ``key``: one sampling pass and one staged write
    instead of one of each per score.
    """
    parts = []
    for i, (_, value, _) in enumerate(specs):
        cols = [F.lit(i).alias("_sid")]
        for j, (_, v, _) in enumerate(specs):
            cols.append((F.col(v) if j == i else F.lit(None).cast(df.schema[v].dataType)).alias(f"_v{j}"))
        parts.append(df.select(F.col(key), *cols))
    stacked = parts[0]
    for p in parts[1:]:
        stacked = stacked.unionByName(p)
    order = [F.col("_sid").asc()]
    for j, (_, _, desc) in enumerate(specs):
        order.append(F.col(f"_v{j}").desc() if desc else F.col(f"_v{j}").asc())
    order.append(F.col(key).asc())
    ranked = global_row_number(stacked, order, "_rn")
    n = (F.col("_rn_total") / len(specs)).cast("bigint")
    within = F.col("_rn") - F.col("_sid") * n
    scored = ranked.select(key, "_sid", ntile_from_rank(within, n, buckets).alias("_score"))
    return scored.groupBy(key).agg(*[F.max(F.when(F.col("_sid") == i, F.col("_score"))).alias(out)
                                     for i, (out, _, _) in enumerate(specs)])
