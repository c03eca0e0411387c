"""Incremental data quality (G01, G03, G06): rule states that can be merged.

The checked table is kept in parts (``sources.parts``).  For every part the state
holds the counts of each row rule; for uniqueness rules it holds key counts by
hash bucket.  A run reads the parts whose files are not those of the last run,
and nothing else of the table:

* row rules of the changed parts are one aggregate over them, stored under the part;
* their keys replace what the changed parts contributed to the key buckets; a
  bucket's duplicates are counted when the bucket changes, the results read the
  buckets' totals only;
* parts that are gone lose their states and keys.

A run over an unchanged table reads no file of it.  Keys are kept as 128-bit
digests; a key with a null column is never a duplicate.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.quality import Rule, _result_row, _violation
from ..sources.parts import PartStore, bucket_of

_UNIQUE = ("unique", "compound_unique")


class QualityState:
    """States of ``rules`` over the table ``table`` of ``source``; ``part_of`` gives the part of a row."""

    def __init__(self, source: PartStore, table: str, part_of: Column, rules: Sequence[Rule], base_dir: str, buckets: int = 16):
        self.source, self.table, self.part_of = source, table, part_of
        self.rules, self.buckets = tuple(rules), buckets
        self.store = PartStore(source.spark, base_dir)

    def _files(self) -> dict[str, str]:
        """The table's parts and what they consist of."""
        entry = self.source.state()["tables"].get(self.table, {"parts": {}})
        return {part: ",".join(folders) for part, folders in entry["parts"].items()}

    def _seen(self) -> dict[str, str]:
        known = self.store.read("seen")
        return {} if known is None else {r.source_part: r.files for r in known.collect()}  # a row per part of the table

    def run(self) -> list[str]:
        """Bring the states up to date; returns the parts that were read."""
        files, seen = self._files(), self._seen()
        changed = sorted(p for p in files if seen.get(p) != files[p])
        gone = sorted(p for p in seen if p not in files)
        if not changed and not gone:
            return []
        change = self.store.change()
        rows = None
        if changed:
            rows = self.source.read(self.table, changed).withColumn("source_part", self.part_of)
            needed = sorted({c for r in self.rules for c in r.columns})
            rows = rows.select("source_part", *needed)
        self._row_states(change, rows, changed + gone)
        self._key_states(change, rows, changed + gone)
        spark = self.source.spark
        now = spark.createDataFrame([(p, f, "all") for p, f in files.items()], "source_part string, files string, part string")
        change.replace("seen", now, ["all"])
        change.publish()
        return changed

    def _row_states(self, change, rows: DataFrame | None, parts: list[str]) -> None:
        row_rules = [r for r in self.rules if r.kind not in _UNIQUE]
        if rows is None:
            empty = self.store.read("states")
            if empty is not None:
                change.replace("states", empty.limit(0).withColumn("part", F.lit("")), parts)
            return
        bad = [F.count_if(_violation(r)).alias(f"_u{r.rule_id}") for r in row_rules if r.kind != "row_count_between"]
        counts = rows.groupBy("source_part").agg(F.count(F.lit(1)).alias("n"), *bad)
        states = F.array(F.struct(F.lit(0).alias("rule_id"), F.lit(0).cast("bigint").alias("unexpected")),
                         *[F.struct(F.lit(r.rule_id).alias("rule_id"), F.col(f"_u{r.rule_id}").alias("unexpected"))
                           for r in row_rules if r.kind != "row_count_between"])
        out = counts.select(F.col("source_part").alias("part"), "n", F.explode(states).alias("s")).select("part", "n", "s.*")
        change.replace("states", out, parts)

    def _key_states(self, change, rows: DataFrame | None, parts: list[str]) -> None:
        unique = [r for r in self.rules if r.kind in _UNIQUE]
        if not unique:
            return
        fresh = []
        for r in unique if rows is not None else ():
            known = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in r.columns])
            key = F.md5(F.to_json(F.struct(*[F.col(c) for c in r.columns])))
            fresh.append(rows.where(known).select(F.lit(r.rule_id).alias("rule_id"), key.alias("key"), "source_part"))
        old = self.store.read("keys")
        keys = None
        if fresh:
            keys = reduce(DataFrame.unionByName, fresh).groupBy("rule_id", "key", "source_part").agg(F.count(F.lit(1)).alias("n"))
        if old is not None:
            # buckets that hold keys of a changed part change, even if it has no such key any more
            stale = old.where(F.col("source_part").isin(parts))
            touched = stale.select(bucket_of("key", self.buckets).alias("part"))
            if keys is not None:
                touched = touched.unionByName(keys.select(bucket_of("key", self.buckets).alias("part")))
            touched = sorted(r.part for r in touched.distinct().collect())
            kept = self.store.read("keys", touched).where(~F.col("source_part").isin(parts))
            keys = kept if keys is None else keys.unionByName(kept.select(*keys.columns))
        else:
            touched = [f"b{i:03d}" for i in range(self.buckets)]
        if keys is None:
            return
        change.replace("keys", keys.withColumn("part", bucket_of("key", self.buckets)), touched)
        keys = change.read("keys", touched).withColumn("part", bucket_of("key", self.buckets))
        each = keys.groupBy("part", "rule_id", "key").agg(F.sum("n").alias("n"))
        totals = each.groupBy("part", "rule_id").agg(
            F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), F.lit(0)).cast("bigint").alias("duplicates"))
        change.replace("duplicates", totals, touched)

    def results(self) -> DataFrame:
        """One row per rule, as ``quality.evaluate`` gives it, out of the states alone."""
        spark = self.source.spark
        states = self.store.read("states")
        if states is None:
            states = spark.createDataFrame([], "n bigint, rule_id int, unexpected bigint")
        double = self.store.read("duplicates")
        if double is None:
            double = spark.createDataFrame([], "rule_id int, duplicates bigint")
        unexpected = states.select("rule_id", "unexpected").unionByName(
            double.select("rule_id", F.col("duplicates").alias("unexpected")))
        total = states.where("rule_id = 0").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"))
        by_rule = unexpected.groupBy("rule_id").agg(F.sum("unexpected").alias("u"))
        sums = total.select("n", by_rule.agg(F.map_from_entries(F.collect_list(F.struct("rule_id", "u")))).scalar().alias("u"))
        rows = []
        for r in self.rules:
            u = F.coalesce(F.try_element_at("u", F.lit(r.rule_id)), F.lit(0))
            if r.kind == "row_count_between":
                ok = (F.col("n") >= r.params.get("min", 0)) & (F.col("n") <= r.params.get("max", 2**62))
                rows.append(_result_row(r, F.col("n"), F.lit(0), ok))
            else:
                rows.append(_result_row(r, F.col("n"), u, u == 0))
        return sums.select(F.explode(F.array(*rows)).alias("r")).select("r.*").orderBy("table_name", "rule_id")
