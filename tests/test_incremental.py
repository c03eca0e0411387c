"""Parts published at once, stored customer history, incremental sales marts."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from martspark.mart import Mart
from martspark.operators import facts, scd2
from martspark.operators import customers as C
from martspark.sources.parts import PartStore
from martspark.streaming.incremental import IncrementalMarts

SMALL = "/root/testdata/sf0.001"


def rows_of(df, columns=None):
    return sorted(map(str, df.select(sorted(columns or df.columns)).collect()))


def _numbers(spark, *pairs):
    return spark.createDataFrame(list(pairs), "n int, part string")


def test_parts_are_replaced_appended_compacted_and_vacuumed(spark, tmp_path):
    store = PartStore(spark, str(tmp_path / "s"))
    assert store.read("t") is None
    change = store.change()
    change.append("t", _numbers(spark, (1, "a"), (2, "b")))
    assert store.read("t") is None and change.publish(7) == 1
    change = store.change()
    change.append("t", _numbers(spark, (3, "a")))
    change.replace("t", _numbers(spark, (9, "b")), ["b", "c"])
    change.publish()
    assert sorted(r.n for r in store.read("t").collect()) == [1, 3, 9]
    assert [r.n for r in store.read("t", ["b"]).collect()] == [9] and store.read("t", ["x"]).count() == 0
    assert sorted(r.n for r in store.read("t", number=1).collect()) == [1, 2] and store.state()["epoch"] == 7
    change = store.change()
    assert change.compact("t", F.when(F.col("n") < 9, "a").otherwise("b"), 1) == ["a"]
    change.publish()
    assert [len(f) for f in store.state()["tables"]["t"]["parts"].values()] == [1, 1]
    assert store.vacuum(keep=1) == 2  # the first folders of both parts
    assert sorted(r.n for r in store.read("t").collect()) == [1, 3, 9]
    change = store.change()
    change.replace("t", _numbers(spark), ["a"])
    change.publish()
    assert [r.n for r in store.read("t").collect()] == [9]


def test_a_second_writer_is_refused_and_stray_parts_too(spark, tmp_path):
    store = PartStore(spark, str(tmp_path / "s"))
    one, two = store.change(), store.change()
    one.append("t", _numbers(spark, (1, "a")))
    two.append("t", _numbers(spark, (2, "a")))
    one.publish()
    with pytest.raises(RuntimeError, match="another writer"):
        two.publish()
    assert [r.n for r in store.read("t").collect()] == [1]
    with pytest.raises(ValueError, match="outside"):
        store.change().replace("t", _numbers(spark, (1, "a"), (2, "b")), ["a"])


def _customers(spark, **names):
    base = Mart(spark, SMALL).stg_customers.select(*scd2.SNAPSHOT_COLS).limit(1).first().asDict()
    schema = Mart(spark, SMALL).stg_customers.select(*scd2.SNAPSHOT_COLS).schema
    return spark.createDataFrame([tuple({**base, "customer_id": k, "customer_name": v}[c] for c in scd2.SNAPSHOT_COLS)
                                  for k, v in names.items()], schema)


def test_history_writes_changed_buckets_only(spark, tmp_path):
    history = scd2.StoredHistory(spark, str(tmp_path / "h"), buckets=8)
    first = _customers(spark, **{f"C{i}": "a" for i in range(20)})
    history.load(first, "2020-01-01 00:00:00")
    second = first.withColumn("customer_name", F.when(F.col("customer_id") == "C3", F.lit("b")).otherwise(F.col("customer_name")))
    before = history.store.state()["tables"]["history"]["parts"]
    written = history.load(second, "2021-01-01 00:00:00")
    after = history.store.state()["tables"]["history"]["parts"]
    assert len(written) == 1 and {p for p in after if after[p] != before[p]} == set(written)
    want = scd2.scd2_apply(scd2.scd2_initial(first), second, "2021-01-01 00:00:00")
    assert rows_of(history.read(), want.columns) == rows_of(want)
    assert rows_of(history.read(1), want.columns) == rows_of(scd2.scd2_initial(first), want.columns)
    assert history.load(second, "2022-01-01 00:00:00") == [] and history.store.state()["number"] == 2
    new = _customers(spark, C99="new")  # a batch of one customer reads and writes one bucket
    assert len(history.load(new, "2022-01-01 00:00:00")) == 1 and history.read().count() == want.count() + 1
    gone = history.load(second.where("customer_id <> 'C5'").unionByName(new), "2023-01-01 00:00:00", close_missing=True)
    assert len(gone) == 1 and history.read().where("customer_id = 'C5' and is_current").count() == 0


def test_a_killed_load_leaves_the_old_history(spark, tmp_path):
    history = scd2.StoredHistory(spark, str(tmp_path / "h"), buckets=8)
    first = _customers(spark, **{f"C{i}": "a" for i in range(20)})
    history.load(first, "2020-01-01 00:00:00")
    old = rows_of(history.read())
    # some buckets are written, then a task fails
    failing = first.withColumn("customer_name", F.when(F.col("customer_id") == "C7", F.raise_error(F.lit("killed")))
                               .otherwise(F.lit("b")))
    with pytest.raises(Exception, match="killed"):
        history.load(failing, "2021-01-01 00:00:00")
    change = history.store.change()  # everything written, not published
    change.replace("history", history.read().limit(0).withColumn("part", F.lit("b000")), ["b000"])
    assert rows_of(history.read()) == old
    history.load(first.withColumn("customer_name", F.lit("b")), "2021-01-01 00:00:00")
    assert history.read().count() == 40


@pytest.fixture(scope="module")
def mart(spark):
    return Mart(spark, SMALL).staged("sales_lines_enriched")


def _marts(spark, tmp_path, mart, **k):
    dims = {"customer": mart.dim_customer, "product": mart.dim_product, "salesperson": mart.dim_salesperson,
            "territory": mart.dim_territory}
    return IncrementalMarts(spark, str(tmp_path / "inc"), lambda: dims, buckets=4, **k), dims


def test_late_and_redelivered_lines_equal_the_batch(spark, tmp_path, mart):
    inc, _ = _marts(spark, tmp_path, mart, most_folders=1)
    lines = mart.sales_lines_enriched
    ids = [r[0] for r in lines.select("customer_id").distinct().orderBy("customer_id").limit(2).collect()]
    late = (F.col("customer_id") == ids[0]) & (F.col("document_date") < "1997-01-01")
    sizes = lines.where(F.col("customer_id") == ids[1]).groupBy("invoice_number").agg(
        F.count(F.lit(1)).alias("n"), F.max("line_item_sequence").alias("last"))
    document = sizes.where("n > 1").orderBy("invoice_number").first()
    half = (F.col("invoice_number") == document.invoice_number) & (F.col("line_item_sequence") == document["last"])
    rest = lines.where(~late & ~half)
    states = []
    for chunk in (rest, lines.where(late), lines.where(half), rest, lines.where(late)):
        inc.land(chunk)
        inc.run(lines.schema)
        states.append(inc.store.state()["tables"])

    def changed(table, i):
        a, b = states[i - 1][table]["parts"], states[i][table]["parts"]
        return {p for p in b if a.get(p) != b[p]}

    few = lines.where(late).select(F.date_format("document_date", "yyyyMM")).distinct().count()
    assert len(changed("documents", 1)) == few and len(changed("history", 1)) == 1
    assert len(changed("documents", 2)) == 1 and len(changed("months", 2)) == 1
    assert states[2] == states[3] == states[4]  # landing a file again changes nothing
    assert all(len(f) == 1 for f in states[-1]["fact_sales"]["parts"].values())  # compacted
    assert rows_of(inc.history()) == rows_of(C.customer_monthly(lines))
    assert rows_of(inc.fact()) == rows_of(mart.fact_sales)


def test_an_epoch_is_published_once(spark, tmp_path, mart):
    inc, _ = _marts(spark, tmp_path, mart)
    lines = mart.sales_lines_enriched.limit(50)
    inc._process(lines, 0)
    number = inc.store.state()["number"]
    inc._process(lines, 0)  # the stream's log was lost after the tables were published
    assert inc.store.state()["number"] == number and inc.fact().count() == 50


def test_late_dimensions_rewrite_the_waiting_facts_only(spark, tmp_path, mart):
    inc, dims = _marts(spark, tmp_path, mart)
    lines = mart.sales_lines_enriched
    known = lines.join(mart.dim_customer.select("customer_id"), "customer_id", "left_semi")
    missing = known.groupBy("customer_id").agg(F.countDistinct(F.trunc("document_date", "month")).alias("m"))
    missing, months = missing.orderBy("m", "customer_id").first()
    item = lines.groupBy("item_number").agg(F.count(F.lit(1)).alias("n")).orderBy("n", "item_number").first()[0]
    dims["customer"] = mart.dim_customer.where(F.col("customer_id") != missing)
    dims["product"] = mart.dim_product.where(F.col("item_number") != item)
    inc.load(lines)
    assert inc.dimensions_changed() == []
    dims["customer"] = mart.dim_customer
    before = inc.store.state()["tables"]
    written = inc.dimensions_changed()
    after = inc.store.state()["tables"]
    assert len(written) == months
    assert {p for p in after["fact_sales"]["parts"] if after["fact_sales"]["parts"][p] != before["fact_sales"]["parts"][p]} \
        == set(written)
    assert len([p for p in after["snapshot"]["parts"] if after["snapshot"]["parts"][p] != before["snapshot"]["parts"][p]]) == 1
    assert before["history"] == after["history"] and before["documents"] == after["documents"]
    assert inc.dimensions_changed() == []
    dims["product"] = mart.dim_product
    assert inc.dimensions_changed()
    assert rows_of(inc.fact()) == rows_of(mart.fact_sales)
    want = facts.fact_customer_monthly_snapshot(C.customer_monthly(lines), mart.dim_customer, mart.dim_salesperson,
                                                mart.dim_territory)
    assert rows_of(inc.snapshot()) == rows_of(want)
