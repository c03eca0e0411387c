"""The binding's Spark forms give the rows of its SQL blocks, with few shuffles, on rows of their own."""

import datetime as dt
import time

import pytest

from compare import multiset

from martspark.operators import dims, sales, staging
from martspark.sources.binding import SOURCE_SQL, Sources

DAY = dt.datetime(2000, 5, 1)


@pytest.fixture()
def tables(spark, tmp_path):
    """Driver tables with repeated and missing keys, rows that come twice, and keys of many digits."""
    big = 12_345_678_901  # more digits than a document number has
    line = [(1, 1, 12345, 1, 2.0, 10.0, 0.1, 0.0, "N", "O", DAY), (1, 1, 12345, 1, 2.0, 10.0, 0.1, 0.0, "N", "O", DAY),
            (1, 2, 7, 1, 3.0, 11.0, 0.0, 0.0, "N", "O", DAY), (1, 1, 7, 2, 1.0, 12.0, 0.2, 0.0, "R", "F", DAY),
            (1, 1, 7, 1, 1.0, 12.0, 0.2, 0.0, None, "F", DAY), (1, None, 7, 1, 1.0, 12.0, 0.2, 0.0, "N", "F", DAY),
            (2, 9, 7, 1, 1.0, 12.0, 0.2, 0.0, "R", "F", DAY), (3, 2, 7, None, 4.0, 9.0, None, 0.0, "A", "F", DAY),
            (None, 1, 7, 1, 1.0, 12.0, 0.2, 0.0, "R", "F", DAY), (8, 1, 7, 1, 1.0, 12.0, 0.2, 0.0, "R", "F", DAY),
            (big, 1, 7, 1, 5.0, 50.0, 0.0, 0.0, "R", "F", DAY), (big // 10, 2, 7, 1, 6.0, 60.0, 0.0, 0.0, "R", "F", DAY)]
    rows = {
        "lineitem": (line, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice "
                     "double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp"),
        "orders": ([(k, c, "O", 5.0, DAY, "1") for k, c in ((1, 1), (2, 2), (3, 1), (3, 1), (8, None), (big, 1),
                                                            (big // 10, 2), (None, 1))],
                   "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp, "
                   "o_orderpriority string"),
        "part": ([(1, "a", "b", "PROMO", 1, 10.0), (2, "c", "b", "PROMO", 1, 20.0), (2, "d", "b", "PROMO", 1, 30.0)],
                 "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double"),
        "customer": ([(1, "x", 3, 1.0, "M"), (2, "y", 4, 1.0, "M")],
                     "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"),
        "nation": ([(i, f"N{i}", i % 2) for i in range(6)], "n_nationkey int, n_name string, n_regionkey int"),
        "supplier": ([(7, "s", 1, 1.0), (9999, "s", 1, 1.0), (12345, "s", 1, 1.0), (123456789, "s", 2, 1.0)],
                     "s_suppkey long, s_name string, s_nationkey int, s_acctbal double"),
    }
    for name, (values, schema) in rows.items():
        spark.createDataFrame(values, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


def _portable(spark, source, sf_dir, **changed):
    """The block's SQL as written."""
    src = Sources(spark, sf_dir)
    text = SOURCE_SQL[source]
    used = {t: src.driver(t) for t in ("lineitem", "orders", "part", "customer") if "{" + t + "}" in text}
    return spark.sql(text, **{**used, **changed})


def test_salespeople_of_any_key(spark, tables):
    """keys from 10,000 on did not fit the commission's type and ended the query."""
    people = staging.stg_salespeople(Sources(spark, tables)["RM00301"])
    want = {"0007": 0.07, "0009999": 99.99, "00012345": 123.45, "000123456789": 1234567.89}
    assert {r.salesperson_id: r.commission_pct for r in people.collect()} == want
    assert {r.salesperson_id: r.commission_pct for r in dims.dim_salesperson(people).collect()} == want


def test_documents_equal_their_sql(spark, tables):
    got, want = Sources(spark, tables)["SOP30200"], _portable(spark, "SOP30200", tables)
    assert got.dtypes == want.dtypes
    got, want = ([tuple(r) for r in x.collect()] for x in (got, want))
    assert len(got) == 7 and multiset(["c"] * len(got[0]), got) == multiset(["c"] * len(want[0]), want)


def test_lines_equal_their_sql(spark, tables):
    """Lines are numbered before orders and parts that come twice repeat them."""
    lines = Sources(spark, tables).driver("lineitem")
    keys = "l_orderkey, l_returnflag = 'R', l_linenumber"
    order = "l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_shipdate"
    numbered = lines.selectExpr("*", f"row_number() over (partition by {keys} order by {order}) as _seq")
    text = SOURCE_SQL["SOP30300"]
    start, end = text.index("cast(row_number()"), text.index(" as CMPNTSEQ")
    src = Sources(spark, tables)
    want = spark.sql(f"{text[:start]}cast(_seq - 1 as int){text[end:]}", lineitem=numbered, orders=src.driver("orders"),
                     part=src.driver("part"))
    got = src["SOP30300"]
    assert got.dtypes == want.dtypes
    got, want = ([tuple(r) for r in x.collect()] for x in (got, want))
    assert len(got) == 14 and multiset(["c"] * len(got[0]), got) == multiset(["c"] * len(want[0]), want)


def test_lines_meet_their_documents_without_a_shuffle(spark, tables):
    """Numbering, orders and headers need the lines by document, the part alone needs them
    otherwise (before: 16 shuffles, now 9)."""
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        src = Sources(spark, tables)
        lines = sales.sales_lines_enriched(staging.stg_sales_headers(src["SOP30200"]), staging.stg_sales_lines(src["SOP30300"]))
        plan = lines._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    # lines (by document, by part, by document), orders and parts; driver lines, orders, customers, and orders by document
    assert plan.count("Exchange hashpartitioning") == 5 + 4


def test_fact_keys_of_documents_equal_those_of_lines(spark, tables):
    """keys looked up by documents and by lines before their metrics are those looked up by wide lines."""
    from martspark.mart import Mart
    from martspark.operators import facts

    m = Mart(spark, tables)
    # a salesperson that comes twice repeats the lines either way, and a product is missing
    m.dim_salesperson = m.dim_salesperson.union(m.dim_salesperson)
    m.dim_product = m.dim_product.where("item_number <> 'P00000002'")
    want = facts.fact_sales(m.sales_lines_enriched, m.dim_customer, m.dim_product, m.dim_salesperson, m.dim_territory)
    assert m.fact_sales.dtypes == want.dtypes
    got, want = ([tuple(r) for r in x.collect()] for x in (m.fact_sales, want))
    assert got and multiset(["c"] * len(got[0]), got) == multiset(["c"] * len(want[0]), want)
    assert len({r[12] for r in got}) == 2 and len({r[13] for r in got}) == 2  # customers; products and the unknown one


def test_wide_lines_are_not_shuffled_to_the_dimensions(spark, tables, monkeypatch):
    """one shuffle of lines for their product (before: one each for customer, product, salesperson and territory)."""
    from martspark.mart import Mart
    from martspark.operators import facts

    monkeypatch.setattr(facts, "small", lambda df: df)

    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = Mart(spark, tables).fact_sales._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    top = plan[:plan.index("SortMergeJoin [invoice_number")]
    shuffles = [x.partition("hashpartitioning(")[2].split("#")[0] for x in top.splitlines() if "Exchange hashpartitioning" in x]
    assert shuffles == ["item_number"]


def test_known_customers_of_documents(spark):
    """F16: lines that bring their customer's state from their document are judged as if it were looked up by line."""
    from martspark.operators import quality

    lines = spark.createDataFrame([("a", 1.0), ("b", 1.0), ("a", None), (None, 1.0)], "customer_id string, net_sales_amount double")
    customers = spark.createDataFrame([("a",), ("a",), (None,)], "customer_id string")
    want = sorted(map(str, quality.quarantine(lines, customers).collect()))
    flagged = quality.known_customers(lines, customers)
    got = quality.quarantine(flagged, spark.createDataFrame([], customers.schema))
    assert got.columns == ["customer_id", "net_sales_amount", "quarantine_reason"]
    assert sorted(map(str, got.collect())) == want


def test_staged_writes_leave_no_shuffle_files(spark, tmp_path):
    """shuffles of a staged frame went with the driver's garbage only, not with the write."""
    from martspark.plans import stage as staged

    setting = spark.conf.get(staged._CLEANUP, None)
    files = lambda: spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    shuffles = lambda: {str(f) for f in _items(files()) if "shuffle_" in str(f)}
    before = shuffles()
    frame = spark.range(1000).selectExpr("id % 7 as k", "id").groupBy("k").sum("id")
    out = staged.stage(frame, "cleanup")
    for _ in range(50):  # the files go in the background
        if left := shuffles() - before:
            time.sleep(0.2)
    assert not left
    assert spark.conf.get(staged._CLEANUP, None) == setting
    assert out.count() == 7 and frame.count() == 7


def _items(seq):
    it = seq.iterator()
    while it.hasNext():
        yield it.next()
