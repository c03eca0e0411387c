"""Quarantine as state with replay.

Loaded lines are split into ``clean`` and ``rejects`` (with the reason), both in
parts by line key and published together (``sources.parts``).  A rejected line
comes back

* when it is delivered again, corrected: the new delivery takes the place of the rejected one;
* when its customer arrives: ``replay`` judges the rejects against the present
  customers and moves what is clean now.

A line is in one of the two tables, once: lines that are already clean are left
out of later loads.  A load reads and writes the key buckets of its lines, a
replay reads the rejects alone and rewrites the buckets in which something changed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.quality import NULL_AMOUNT_REASON, UNKNOWN_CUSTOMER_REASON, quarantine
from ..plans.stage import discard, stage
from ..sources.parts import PartStore, bucket_of

LINE_KEY = ["invoice_number", "line_item_sequence", "component_sequence"]


class Quarantine:
    def __init__(self, spark: SparkSession, base_dir: str, buckets: int = 16):
        self.store, self.buckets = PartStore(spark, base_dir), buckets

    def _part(self):
        return bucket_of("invoice_number", self.buckets)

    def load(self, lines: DataFrame, customers: DataFrame) -> None:
        """Judge lines (new ones, or rejected ones delivered again)."""
        judged = quarantine(lines.dropDuplicates(LINE_KEY), customers).withColumn("part", self._part())
        judged = stage(judged, "judged")
        parts = [r.part for r in judged.select("part").distinct().collect()]
        clean = self.store.read("clean", parts)
        fresh = judged if clean is None else judged.join(clean.select(*LINE_KEY), LINE_KEY, "left_anti")
        rejects = fresh.where(F.col("quarantine_reason").isNotNull())
        waiting = self.store.read("rejects", parts)
        if waiting is not None:
            kept = waiting.join(judged.select(*LINE_KEY), LINE_KEY, "left_anti").withColumn("part", self._part())
            rejects = rejects.unionByName(kept.select(*rejects.columns))
        change = self.store.change()
        change.append("clean", fresh.where(F.col("quarantine_reason").isNull()).drop("quarantine_reason"))
        change.replace("rejects", rejects, parts)
        change.publish()
        discard(judged)

    def replay(self, customers: DataFrame) -> list[str]:
        """Judge the rejects again; returns the rewritten buckets."""
        waiting = self.store.read("rejects")
        if waiting is None:
            return []
        again = quarantine(waiting.withColumnRenamed("quarantine_reason", "_was"), customers)
        again = stage(again.withColumn("part", self._part()), "judged")
        changed = again.where(~F.col("quarantine_reason").eqNullSafe(F.col("_was"))).select("part").distinct()
        parts = [r.part for r in changed.collect()]
        if parts:
            change = self.store.change()
            free = again.where(F.col("quarantine_reason").isNull()).drop("quarantine_reason", "_was")
            change.append("clean", free)
            left = again.where(F.col("part").isin(parts) & F.col("quarantine_reason").isNotNull()).drop("_was")
            change.replace("rejects", left, parts)
            change.publish()
        discard(again)
        return sorted(parts)

    def clean(self) -> DataFrame:
        return self.store.read("clean")

    def rejects(self) -> DataFrame:
        return self.store.read("rejects")

    def counts(self) -> DataFrame:
        """One row: clean lines, and rejected ones by reason."""
        rows = self.clean().select(F.lit(None).cast("string").alias("reason")).unionByName(
            self.rejects().select(F.col("quarantine_reason").alias("reason")))
        return rows.agg(F.count_if(F.col("reason").isNull()).alias("clean_rows"),
                        F.count_if(F.col("reason") == UNKNOWN_CUSTOMER_REASON).alias("unknown_customer_rows"),
                        F.count_if(F.col("reason") == NULL_AMOUNT_REASON).alias("null_amount_rows"))
