"""Exchange rates: as-of (backward) rate per document date (M01) and the
effective-rate rule (M02), plus the latest rate (SURVEY D28).

Plan for the as-of join (no nested loop, no per-row search): the rate table
(one row per rate date, bounded by the calendar) is turned into a forward-filled
daily calendar ``[rate_date, next_rate_date)`` with ``explode(sequence(...))``
and joined to the facts by **equality** on the date.  The calendar has at most
366 rows per year of rates, so it is broadcast and the fact side never shuffles
for this join.  Documents dated after the last rate take the latest rate, which
is a scalar subquery; documents before the first rate get NULL (→ 1.0 in M02).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import labels as L
from ..plans.broadcast import bounded


def service_rates(mc00100: DataFrame, table_id: str = L.FX_TABLE) -> DataFrame:
    """Rates of one table as the service reads them: (exch_date, xchg_rate double).

    Several rates on one date collapse to one; the source gives no order among
    them, so the highest rate is kept (deterministic ``keep last``).
    """
    return (
        mc00100.where((F.trim("EXGTBLID") == F.lit(table_id)) & (F.col("XCHGRATE") > 0))
        .select(F.col("EXCHDATE").cast("date").alias("exch_date"),
                F.col("XCHGRATE").cast("double").alias("xchg_rate"))
        .groupBy("exch_date").agg(F.max("xchg_rate").alias("xchg_rate"))
    )


def rate_calendar(rates: DataFrame) -> DataFrame:
    """Forward-filled daily calendar (cal_date, exch_date, xchg_rate).

    The ordering window has no partition key on purpose: its input is one row
    per rate date (a few thousand rows for decades of rates), not fact data.
    """
    w = Window.orderBy("exch_date")
    intervals = rates.withColumn("next_date", F.lead("exch_date").over(w))
    last_day = F.coalesce(F.date_sub("next_date", 1), F.col("exch_date"))
    return intervals.select(
        F.explode(F.sequence(F.col("exch_date"), last_day)).alias("cal_date"),
        "exch_date", "xchg_rate",
    )


def latest_rate(rates: DataFrame) -> Column:
    """Rate of the greatest date in the table (scalar subquery), SURVEY D28; 1.0 without any rate."""
    return rates.select(F.coalesce(F.max_by("xchg_rate", "exch_date"), F.lit(1.0))).scalar()


def latest_rate_date(rates: DataFrame) -> Column:
    return rates.select(F.max("exch_date")).scalar()


def asof_join(facts: DataFrame, rates: DataFrame, date_col: str = "document_date") -> DataFrame:
    """Add ``exch_date`` and ``xchg_rate`` = last rate with date ≤ ``date_col``."""
    cal = bounded(rate_calendar(rates))
    joined = facts.join(cal, facts[date_col] == cal["cal_date"], "left").drop("cal_date")
    # latest date and rate in one scalar subquery (one job, one row)
    last = rates.select(F.struct(F.max("exch_date").alias("d"),
                                 F.max_by("xchg_rate", "exch_date").alias("r"))).scalar()
    joined = joined.withColumn("_last", last)
    after_last = F.col(date_col) > F.col("_last.d")
    return joined.select(
        *[F.col(c) for c in facts.columns],
        F.when(after_last, F.col("_last.d")).otherwise(F.col("exch_date")).alias("exch_date"),
        F.when(after_last, F.col("_last.r")).otherwise(F.col("xchg_rate")).alias("xchg_rate"),
    )


def effective_rate(header_rate: Column, asof_rate: Column) -> Column:
    """Header rate if > 0, else as-of rate if > 0, else 1.0."""
    return (F.when(header_rate > 0, header_rate)
            .when(asof_rate > 0, asof_rate)
            .otherwise(F.lit(1.0)))
