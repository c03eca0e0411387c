"""Tables that grow with the business are not sent whole through the driver."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from martspark.plans.broadcast import small
from martspark.session import prepare

KEY = "spark.sql.autoBroadcastJoinThreshold"


@pytest.fixture
def fresh(spark):
    """A session whose user set no threshold, as prepared for the marts."""
    s = spark.newSession()
    s.conf.unset(KEY)
    return prepare(s)


def _tables(s, tmp_path, rows):
    s.range(rows).select(F.col("id").alias("k")).write.parquet(f"{tmp_path}/dim-{rows}")
    s.range(rows * 4).select(F.pmod("id", F.lit(rows)).alias("f"), "id").write.parquet(f"{tmp_path}/facts-{rows}")
    return s.read.parquet(f"{tmp_path}/facts-{rows}"), s.read.parquet(f"{tmp_path}/dim-{rows}")


def _plan(df):
    return df._jdf.queryExecution().sparkPlan().toString()


@pytest.mark.parametrize("hint", [lambda d: d, small])
def test_a_dimension_of_several_hundred_thousand_rows_is_not_broadcast(fresh, tmp_path, hint):
    facts, dim = _tables(fresh, tmp_path, 400_000)
    j = facts.join(hint(dim), F.col("f") == F.col("k"), "left")
    assert "BroadcastHashJoin" not in _plan(j)
    assert j.where(F.col("k").isNotNull()).count() == 1_600_000


def test_a_small_dimension_still_is(fresh, tmp_path):
    facts, dim = _tables(fresh, tmp_path, 1_000)
    assert "BroadcastHashJoin" in _plan(facts.join(small(dim), F.col("f") == F.col("k"), "left"))


def test_the_threshold_of_a_user_stays(spark):
    s = spark.newSession()
    s.conf.set(KEY, "12345678")
    assert prepare(s).conf.get(KEY) == "12345678"


@pytest.mark.parametrize("hint", [lambda d: d, small])
def test_a_user_threshold_does_not_broadcast_compressed_dimensions(spark, tmp_path, hint):
    s = spark.newSession()
    s.conf.set(KEY, str(10 * 1024 * 1024))  # Spark's own value, set explicitly
    prepare(s)
    facts, dim = _tables(s, tmp_path, 400_000)
    j = facts.join(hint(dim), F.col("f") == F.col("k"), "left")
    assert "BroadcastHashJoin" not in _plan(j)
    assert j.where(F.col("k").isNotNull()).count() == 1_600_000


def test_joins_planned_at_run_time_keep_the_limit(spark, tmp_path):
    s = spark.newSession()
    s.conf.set(KEY, str(10 * 1024 * 1024))
    prepare(s)
    facts, dim = _tables(s, tmp_path, 200_000)  # about 3 MB when shuffled
    j = facts.join(dim, F.col("f") == F.col("k"))
    assert len(j.collect()) == 800_000
    assert "BroadcastHashJoin" not in j._jdf.queryExecution().executedPlan().toString()


def test_the_run_time_threshold_of_a_user_stays(spark):
    s = spark.newSession()
    s.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "7654321")
    assert prepare(s).conf.get("spark.sql.adaptive.autoBroadcastJoinThreshold") == "7654321"
