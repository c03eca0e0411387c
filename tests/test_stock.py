"""Stock over time and layers of the stock against plain loops."""

from __future__ import annotations

import datetime as dt
import random
from decimal import Decimal

from pyspark.sql import functions as F

from martspark.operators import stock
from martspark.plans.ranking import keyed_running_sum

TODAY = dt.date(2020, 5, 17)
ENDS = [TODAY, dt.date(2020, 4, 30), dt.date(2020, 3, 31), dt.date(2020, 2, 29)]


def test_month_ends_are_walked_back_from_todays_stock(spark):
    rng = random.Random(2)
    trx = [(rng.randint(1, 7), f"i{rng.randint(0, 3)}", rng.choice(["A", "B", "DEFAULT_LOC"]), rng.choice([None, "A", "C"]),
            TODAY - dt.timedelta(days=rng.randint(-20, 130)), Decimal(rng.randint(1, 9))) for _ in range(400)]
    df = spark.createDataFrame(trx, "doc_type int, item_number string, from_location_code string, to_location_code string, "
                                    "doc_date date, trx_qty decimal(19,4)")
    moves = [(i, a, d, q if t in (1, 5, 6) else -q) for t, i, a, b, d, q in trx if t != 7]
    moves += [(i, b or "DEFAULT_LOC", d, q) for t, i, a, b, d, q in trx if t == 3]
    signed = stock.signed_movements(df)
    assert sorted(map(tuple, signed.collect())) == sorted(moves)
    now = {("i0", "A"): Decimal(50), ("i1", "B"): Decimal(7), ("i9", "A"): Decimal(3)}
    held = spark.createDataFrame([(*k, q) for k, q in now.items()], "item_number string, location_code string, qty_on_hand decimal(19,4)")
    got = {(r.item_number, r.location_code, r.month_end): r.balance_qty
           for r in stock.month_end_stock(held, signed, TODAY, months=3).collect()}
    keys = set(now) | {(i, a) for i, a, d, _ in moves if dt.date(2020, 2, 1) <= d <= TODAY}
    want = {(*k, e): now.get(k, 0) - sum(q for i, a, d, q in moves if (i, a) == k and e < d <= TODAY) for k in keys for e in ENDS}
    assert got == want


def _layers(spark, rows):
    return spark.createDataFrame(rows, "item_number string, location_code string, date_received date, receipt_sequence_num int, "
                                       "receipt_number string, qty_on_hand_layer decimal(19,4), unit_cost_vef decimal(19,4)")


def test_layers_add_up_to_the_stock(spark):
    rng = random.Random(3)
    day = dt.date(2020, 1, 1)
    # i0 is hot: more layers than one range piece holds
    rows = [("i0" if k < 900 else f"i{rng.randint(1, 4)}", "A", day + dt.timedelta(days=rng.randint(0, 40)), k, f"r{k}",
             Decimal(rng.randint(1, 5)), Decimal(rng.randint(1, 9))) for k in range(1000)]
    now = {"i0": 777, "i1": 3, "i2": 10_000, "i3": 0, "i4": -5, "i7": 4}
    values = spark.createDataFrame([(i, Decimal(q), Decimal(2)) for i, q in now.items()],
                                   "item_number string, qty_on_hand decimal(19,4), unit_cost_vef_used decimal(19,4)")
    got = stock.stock_layers(_layers(spark, rows), values, F.lit(2.0)).collect()
    want = []
    for item, left in now.items():
        for i, loc, d, k, r, q, cost in sorted((x for x in rows if x[0] == item), key=lambda x: (x[2], x[3]), reverse=True):
            if left > 0:
                want.append((i, r, min(q, left), cost))
                left -= min(q, left)
        if left > 0:
            want.append((item, None, left, Decimal(2)))
    assert sorted(((r.item_number, r.receipt_number, r.allocated_qty, r.unit_cost_vef) for r in got), key=str) == sorted(want, key=str)
    total = {i: sum(r.allocated_qty for r in got if r.item_number == i) for i in now}
    assert total == {i: max(q, 0) for i, q in now.items()}
    assert all(r.allocated_value_usd == float(r.allocated_qty * r.unit_cost_vef) / 2 for r in got)


def test_keyed_running_sum_equals_the_window(spark):
    from pyspark.sql import Window

    df = spark.range(3000).select(F.when(F.col("id") % 3 > 0, 1).otherwise(F.col("id") % 7).alias("k"), "id",
                                  (F.col("id") % 11).alias("v"))
    got = keyed_running_sum(df, ["k"], [F.col("id").desc()], "v", "s", num_partitions=16)
    want = df.withColumn("s", F.sum("v").over(Window.partitionBy("k").orderBy(F.col("id").desc())))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
