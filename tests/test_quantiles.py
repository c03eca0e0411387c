"""Order statistics by refinement against a plain sort."""

from __future__ import annotations

import random
from decimal import Decimal

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from martspark.plans import quantiles as Q


def _frame(spark, n, seed=1):
    rng = random.Random(seed)
    rows = [(f"c{i:05d}", rng.choice([None, 1, 2, 3, 3, 3, 50]), Decimal(rng.randrange(-500, 500)) / 100, float(rng.random()))
            for i in range(n)]
    rng.shuffle(rows)
    return spark.createDataFrame(rows, "k string, few int, money decimal(12,2), real double").cache()


@pytest.mark.parametrize("n,limit", [(3000, 8), (3000, 200), (7, 2), (3, 2048), (1, 1), (0, 5)])
def test_ntiles_equal_the_window(spark, n, limit):
    df = _frame(spark, n)
    specs = {"a": Q.Spec("few"), "b": Q.Spec("few", descending=True), "c": Q.Spec("money"), "d": Q.Spec("real", descending=True)}
    got = Q.ntiles(df, "k", specs, 5, limit)
    for name, s in specs.items():
        order = F.col(s.value).desc() if s.descending else F.col(s.value).asc()
        df = df.withColumn(name, F.ntile(5).over(Window.orderBy(order, F.col("k").asc())))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, df.collect()))


@pytest.mark.parametrize("n", [0, 1, 2, 999, 1000])
def test_medians(spark, n):
    df = _frame(spark, n).select("k", "money", "real")
    want = df.select(F.median("money"), F.median("real")).first()
    assert Q.medians(df, "k", ["money", "real"], limit=10) == pytest.approx(list(want))


def test_one_value_is_cut_by_key(spark):
    df = spark.range(20_000).select(F.format_string("k%06d", "id").alias("k"), F.lit(1).alias("v"))
    n, (found,) = Q.order_statistics(df, "k", [Q.Spec("v")], lambda n: [1, n // 2, n], limit=50)
    assert n == 20_000 and found == [(1, "k000000"), (1, "k009999"), (1, "k019999")]
