"""M15 by time slices against the plain range join."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from martspark.functions import labels as L
from martspark.operators import scd2
from martspark.operators.dims import unknown_key


def _frames(spark):
    rng = random.Random(4)
    versions, facts = [], []
    for c in range(12):
        cuts = sorted({f"{rng.randint(1999, 2003)}-{rng.randint(1, 12):02d}-{rng.randint(1, 28):02d} 00:00:00"
                       for _ in range(rng.randint(1, 5))})
        for i, start in enumerate(cuts):
            versions.append((f"c{c}", f"c{c}v{i}", start, cuts[i + 1] if i + 1 < len(cuts) else "9999-12-31 23:59:59"))
    for i in range(2000):
        c = "c0" if i % 3 == 0 else f"c{rng.randint(0, 13)}"  # a hot customer, and customers without history
        facts.append((i, c, f"{rng.randint(1998, 2004)}-{rng.randint(1, 12):02d}-{rng.randint(1, 28):02d}"))
    facts += [(9001, None, "2001-01-01"), (9002, "c1", None)]
    h = spark.createDataFrame(versions, "customer_id string, customer_sk string, f string, t string")
    h = h.select("customer_id", "customer_sk", F.col("f").cast("timestamp").alias("valid_from"),
                 F.col("t").cast("timestamp").alias("valid_to"))
    f = spark.createDataFrame(facts, "n int, customer_id string, d string")
    return f.select("n", "customer_id", F.col("d").cast("date").alias("document_date")), h


@pytest.mark.parametrize("days", [1, 31, 91, 100_000])
def test_sliced_join_equals_the_range_join(spark, days):
    facts, history = _frames(spark)
    at = F.col("document_date").cast("timestamp")
    want = facts.join(history.withColumnRenamed("customer_id", "k"),
                      (F.col("customer_id") == F.col("k")) & (at >= F.col("valid_from")) & (at < F.col("valid_to")), "left")
    want = want.select("n", "customer_id", "document_date", F.coalesce("customer_sk", unknown_key(L.UNKNOWN_CUSTOMER)))
    got = scd2.point_in_time(facts, history, slice_days=days)
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, map(tuple, want.collect())))
    assert scd2.point_in_time(facts.limit(0), history).count() == 0


def test_the_join_is_on_customer_and_slice(spark):
    facts, history = _frames(spark)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = scd2.point_in_time(facts, history)._jdf.queryExecution().sparkPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    join = next(x for x in plan.split("\n") if "Join" in x)
    assert "SortMergeJoin [customer_id" in join and join.count("FLOOR(") + join.count("h_slice") >= 2
    assert "Broadcast" not in plan and "NestedLoop" not in plan
