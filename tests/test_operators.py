"""Edge-case frames (FIXTURES §3) and algebraic checks of the hand-shaped plans."""

import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from martspark.functions import labels as L
from martspark.operators import customers as C
from martspark.operators import fx, inventory, quality, receivables, scd2, staging
from martspark.operators.privacy import mask_name, mask_phone
from martspark.plans.ranking import global_median, global_ntile, global_row_number, keyed_row_number
from martspark.plans.topk import top_k_per_group

D = dt.date


# ------------------------------------------------------------ staging_dirty
def test_staging_trims_blanks_and_bad_numbers(spark):
    rows = [("  C1  ", "Name ", "  ", "abc", Decimal("1.0000")),
            (None, "x", "A", "1", Decimal("0")),
            ("   ", "y", "B", "2", Decimal("0")),
            ("C2", "z", " GOLD ", "3", Decimal("15.0000"))]
    df = spark.createDataFrame(rows, "CUSTNMBR string, CUSTNAME string, CUSTCLAS string, CRLMTTYP string, "
                                     "CUSTDISC decimal(8,4)")
    for c in ("CPRCSTNM", "CNTCPRSN", "STMTNAME", "SHRTNAME", "ADDRESS1", "ADDRESS2", "CITY", "STATE", "ZIP",
              "COUNTRY", "PHONE1", "PHONE2", "FAX", "SLPRSNID", "SALSTERR", "PYMTRMID", "CHEKBKID"):
        df = df.withColumn(c, F.lit(" "))
    df = (df.withColumn("CRLMTAMT", F.lit("12.5")).withColumn("INACTIVE", F.lit(0))
          .withColumn("CREATDDT", F.lit(None).cast("timestamp")).withColumn("MODIFDT", F.lit(None).cast("timestamp")))
    out = {r.customer_id: r for r in staging.stg_customers(df).collect()}
    assert set(out) == {"C1", "C2"}
    assert out["C1"].customer_class_id is None and out["C1"].credit_limit_type is None
    assert out["C2"].customer_class_id == "GOLD" and out["C2"].credit_limit_type == 3
    assert out["C2"].customer_discount_pct == pytest.approx(0.15)
    assert out["C1"].city is None


# ------------------------------------------------------------------ fx_gaps
def test_asof_rate_gaps_duplicates_zero(spark):
    mc = spark.createDataFrame(
        [("USD-VENTAS ", D(2020, 1, 10), Decimal("5.0")), ("USD-VENTAS", D(2020, 1, 10), Decimal("6.0")),
         ("USD-VENTAS", D(2020, 3, 1), Decimal("7.0")), ("USD-VENTAS", D(2020, 4, 1), Decimal("0")),
         ("USD-COMPRAS", D(2020, 2, 1), Decimal("99"))],
        "EXGTBLID string, EXCHDATE date, XCHGRATE decimal(19,7)")
    rates = fx.service_rates(mc)
    docs = spark.createDataFrame([(1, D(2020, 1, 1), 0.0), (2, D(2020, 1, 10), 0.0), (3, D(2020, 2, 20), 0.0),
                                  (4, D(2020, 5, 5), 0.0), (5, D(2020, 2, 20), 4.5)],
                                 "id int, document_date date, header_rate double")
    j = fx.asof_join(docs, rates).select(
        "id", "xchg_rate", fx.effective_rate(F.col("header_rate"), F.col("xchg_rate")).alias("eff"))
    got = {r.id: (r.xchg_rate, r.eff) for r in j.collect()}
    assert got[1] == (None, 1.0)          # before the first rate
    assert got[2] == (6.0, 6.0)           # duplicate date: one rate kept
    assert got[3] == (6.0, 6.0)           # gap of weeks: last rate carried
    assert got[4] == (7.0, 7.0)           # zero rate ignored, after the last rate
    assert got[5] == (6.0, 4.5)           # header rate wins


def test_asof_plan_is_equi_broadcast(spark):
    mc = spark.createDataFrame([("USD-VENTAS", D(2020, 1, 1), Decimal("5"))],
                               "EXGTBLID string, EXCHDATE date, XCHGRATE decimal(19,7)")
    docs = spark.range(10).select(F.date_add(F.lit(D(2020, 1, 1)), F.col("id").cast("int")).alias("document_date"))
    plan = fx.asof_join(docs, fx.service_rates(mc))._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "NestedLoop" not in plan and "Cartesian" not in plan


# --------------------------------------------------------------- churn_edges
def _brute_churn(rows):
    """The service loop: per month present, last purchase up to target."""
    months = sorted({d.replace(day=1) for _, d in rows})
    out = {}
    for m in months:
        target = m + dt.timedelta(days=28)
        cutoff = target - dt.timedelta(days=90)
        last = {}
        for c, d in rows:
            if d <= target:
                last[c] = max(last.get(c, d), d)
        act = sum(1 for v in last.values() if v >= cutoff)
        out[m.strftime("%Y-%m")] = (act, len(last) - act)
    return out


def _churn_frame(spark, rows):
    return spark.createDataFrame([(c, d, "INV") for c, d in rows],
                                 "customer_id string, document_date date, invoice_number string")


def test_churn_history_edges(spark):
    rows = [("a", D(2020, 1, 30)), ("a", D(2020, 4, 28)), ("b", D(2020, 1, 31)), ("c", D(2019, 12, 1)),
            ("d", D(2020, 2, 29)), ("e", D(2021, 2, 28)), ("e", D(2021, 3, 1)), ("f", D(2020, 3, 31))]
    got = {r.year_month: (r.active_customers, r.churned_customers)
           for r in C.churn_history(_churn_frame(spark, rows)).collect()}
    assert got == _brute_churn(rows)


def test_churn_history_random_against_loop(spark):
    rnd = random.Random(7)
    for _ in range(3):
        rows = [(f"c{rnd.randrange(25)}", D(2019, 1, 1) + dt.timedelta(days=rnd.randrange(800)))
                for _ in range(120)]
        got = {r.year_month: (r.active_customers, r.churned_customers)
               for r in C.churn_history(_churn_frame(spark, rows)).collect()}
        assert got == _brute_churn(rows)


# ------------------------------------------------------------------ rfm_ties
@pytest.mark.parametrize("n", [1, 3, 5, 7, 23])
def test_global_ntile_equals_window_ntile(spark, n):
    rnd = random.Random(n)
    df = spark.createDataFrame([(f"k{i:03d}", rnd.randrange(4)) for i in range(n)], "k string, v int")
    order = [F.col("v").desc(), F.col("k").asc()]
    mine = {r.k: r.q for r in global_ntile(df, order, 5, "q").collect()}
    ref = {r.k: r.q for r in df.select("k", F.ntile(5).over(Window.orderBy(*order)).alias("q")).collect()}
    assert mine == ref


def test_global_row_number_is_a_permutation(spark):
    df = spark.range(0, 1000).select((F.col("id") * 7919 % 1000).alias("v"), F.col("id").cast("string").alias("k"))
    r = global_row_number(df, [F.col("v").asc(), F.col("k").asc()], "rn").orderBy("rn").collect()
    assert [x.rn for x in r] == list(range(1, 1001))
    assert [x.v for x in r] == sorted(x.v for x in r)


@pytest.mark.parametrize("parts", [1, 3, 8])
def test_keyed_row_number_equals_window_with_hot_key(spark, parts):
    rnd = random.Random(parts)
    # a third of the rows on one key, a null key, many small keys
    keys = ["hot" if i % 3 == 0 else (None if i % 17 == 0 else f"k{i % 40}") for i in range(900)]
    df = spark.createDataFrame([(k, rnd.randrange(60), i) for i, k in enumerate(keys)], "g string, v int, id int")
    order = [F.col("v").desc(), F.col("id").asc()]
    got = keyed_row_number(df, ["g"], order, "rn", num_partitions=parts)
    ref = df.select("id", F.row_number().over(Window.partitionBy("g").orderBy(*order)).alias("rn"))
    assert sorted((r.id, r.rn) for r in got.select("id", "rn").collect()) == sorted(map(tuple, ref.collect()))
    assert got.columns == ["g", "v", "id", "rn"]


def test_keyed_row_number_splits_a_hot_key_over_tasks(spark):
    df = spark.range(0, 3000).select(F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(
        (F.col("id") % 50).cast("string")).alias("g"), F.col("id"))
    plan = keyed_row_number(df, ["g"], [F.col("id").asc()], "rn", num_partitions=8)
    # the hot key's rows land in several range partitions, and no window groups by the key alone
    pieces = plan.where(F.col("g") == "hot").select(F.spark_partition_id()).distinct().count()
    assert pieces > 1
    assert sorted(r.rn for r in plan.where(F.col("g") == "hot").collect()) == list(range(1, 1001))


@pytest.mark.parametrize("vals", [[5.0], [1.0, 2.0], [3.0, 1.0, 2.0, 10.0], [2.5, 2.5, 2.5, 1.0, 9.0]])
def test_global_median_interpolates(spark, vals):
    import statistics
    df = spark.createDataFrame([(float(v), f"k{i}") for i, v in enumerate(vals)], "v double, k string")
    got = global_median(df, "v", "k").first()[0]
    assert got == pytest.approx(statistics.median(vals))


def test_top_k_per_group_matches_window(spark):
    rnd = random.Random(3)
    rows = [("hot" if i % 3 else f"c{i % 7}", i, rnd.randrange(50)) for i in range(600)]
    df = spark.createDataFrame(rows, "g string, id int, v int")
    order = [F.col("v").desc(), F.col("id").desc()]
    mine = {(r.g, r.id, r.rank) for r in top_k_per_group(df, ["g"], order, 5, ["id"], salt_buckets=8).collect()}
    w = Window.partitionBy("g").orderBy(*order)
    ref = {(r.g, r.id, r.rank) for r in df.withColumn("rank", F.row_number().over(w)).where("rank <= 5").collect()}
    assert mine == ref


# ----------------------------------------------------------- inventory_edges
def test_inventory_service_edges(spark):
    stock = spark.createDataFrame(
        [("A", "MP", 1, 0.0, 0.0, 5.0, 10.0), ("B", "x", 1, 10.0, 10.0, 5.0, 10.0), ("C", "ME", 1, 100.0, 50.0, 5.0, 0.0)],
        "item_number string, category string, record_type int, qty_on_hand double, qty_available double, "
        "safety_stock double, unit_cost_vef double")
    stock = stock.withColumn("sku_type", inventory.sku_type(F.col("category")))
    cogs = spark.createDataFrame([("A", 3.0, 100.0), ("B", 0.0, 0.0)],
                                 "item_number string, annual_units_sold double, annual_cogs_vef double")
    out = {r.item_number: r for r in inventory.inventory_items(stock, cogs, F.lit(2.0)).collect()}
    assert out["A"].health_status == L.HEALTH_STOCKOUT
    assert out["B"].dio == 999.0 and out["B"].health_status == L.HEALTH_EXCESS
    assert out["C"].unit_cost_usd == 0.0 and out["C"].inventory_turnover == 0.0
    assert out["C"].sku_type == "ME" and out["B"].sku_type == "PT"


# ------------------------------------------------------------------ ar_edges
def test_aging_buckets_boundaries(spark):
    as_of = D(2020, 6, 1)
    days = [None, 0, 1, 30, 31, 60, 61, 90, 91]
    due = [None if d is None else as_of - dt.timedelta(days=d) for d in days]
    ar = spark.createDataFrame(
        [(f"C{i}", f"D{i}", 7 if i == 2 else 1, d, Decimal("10.0000")) for i, d in enumerate(due)],
        "CUSTNMBR string, DOCNUMBR string, RMDTYPAL int, DUEDATE date, CURTRXAM decimal(19,4)")
    ar = (ar.withColumn("ORTRXAMT", F.col("CURTRXAM")).withColumn("VOIDSTTS", F.lit(0))
          .withColumn("DOCDATE", F.col("DUEDATE")).withColumn("CURNCYID", F.lit("VEF"))
          .withColumn("SLPRSNID", F.lit("")).withColumn("SLSTERCD", F.lit("")))
    empty_c = spark.createDataFrame([], "CUSTNMBR string, CUSTNAME string, CUSTCLAS string, CRLMTAMT decimal(19,2)")
    empty_sp = spark.createDataFrame([], "SLPRSNID string, SLPRSNFN string, SPRSNSLN string, SALSTERR string")
    empty_t = spark.createDataFrame([], "SALSTERR string, SLTERDSC string")
    docs = receivables.ar_documents(ar, empty_c, empty_sp, empty_t, F.lit(2.0), as_of)
    got = {r.doc_number: (r.overdue_days, r.aging_bucket, r.balance_usd) for r in docs.collect()}
    b = L.AGING_BUCKETS
    assert got["D0"] == (0, b[0], 5.0)
    assert got["D1"][1] == b[0] and got["D2"][1] == b[1] and got["D2"][2] == -5.0
    assert got["D3"][1] == b[1] and got["D4"][1] == b[2] and got["D5"][1] == b[2]
    assert got["D6"][1] == b[3] and got["D7"][1] == b[3] and got["D8"][1] == b[4]
    names = {r.customer_name for r in docs.collect()}
    assert names == {None}
    # NULL customer names are dropped from the directory (pandas group-by keys)
    assert receivables.ar_customer_directory(docs).count() == 0


# --------------------------------------------------------------- scd2_batches
def _cust(spark, rows):
    cols = list(scd2.SNAPSHOT_COLS)
    data = []
    for r in rows:
        base = {c: None for c in cols}
        base.update(r)
        data.append(tuple(base[c] for c in cols))
    schema = ", ".join(f"{c} {'decimal(19,2)' if c == 'credit_limit_amount' else 'int' if c in ('credit_limit_type', 'is_inactive') else 'timestamp' if c in ('created_at', 'modified_at') else 'string'}" for c in cols)
    return spark.createDataFrame(data, schema)


def test_scd2_apply_cases_and_idempotence(spark):
    t0 = dt.datetime(2020, 1, 1)
    b1 = _cust(spark, [
        {"customer_id": "A", "customer_name": "a", "territory_id": "1", "created_at": t0},
        {"customer_id": "B", "customer_name": "b", "territory_id": None, "created_at": t0},
        {"customer_id": "C", "customer_name": "c", "territory_id": "3", "created_at": t0},
        {"customer_id": "M", "customer_name": "m", "created_at": t0},
        {"customer_id": "U", "customer_name": "u", "city": "x", "created_at": t0}])
    b2 = _cust(spark, [
        {"customer_id": "A", "customer_name": "a", "territory_id": "2", "created_at": t0},   # changed
        {"customer_id": "B", "customer_name": "b", "territory_id": "9", "created_at": t0},   # NULL → value
        {"customer_id": "C", "customer_name": "c", "territory_id": None, "created_at": t0},  # value → NULL
        {"customer_id": "U", "customer_name": "u", "city": "y", "created_at": t0},           # untracked
        {"customer_id": "N", "customer_name": "n", "created_at": t0}])                       # new
    h1 = scd2.scd2_initial(b1)
    h2 = scd2.scd2_apply(h1, b2, "2021-01-01 00:00:00")
    rows = h2.collect()
    by = {}
    for r in rows:
        by.setdefault(r.customer_id, []).append(r)
    assert len(by["A"]) == 2 and len(by["B"]) == 2 and len(by["C"]) == 2
    assert len(by["U"]) == 1 and by["U"][0].city == "x"
    assert len(by["M"]) == 1 and by["M"][0].is_current            # missing key stays open
    assert len(by["N"]) == 1 and by["N"][0].valid_from == dt.datetime(2021, 1, 1)
    cur_a = [r for r in by["A"] if r.is_current][0]
    old_a = [r for r in by["A"] if not r.is_current][0]
    assert cur_a.territory_id == "2" and old_a.valid_to == dt.datetime(2021, 1, 1)
    h3 = scd2.scd2_apply(h2, b2, "2021-02-01 00:00:00")
    key = lambda r: (r.customer_id, r.valid_from, r.valid_to, r.is_current)
    assert sorted(map(key, h3.collect())) == sorted(map(key, rows))
    closed = scd2.scd2_apply(h1, b2, "2021-01-01 00:00:00", close_missing=True)
    assert not [r for r in closed.collect() if r.customer_id == "M"][0].is_current


def test_scd2_from_changes_equals_apply(spark):
    from martspark.mart import Mart
    m = Mart(spark, "/root/testdata/sf0.001")
    load = "1998-01-01 00:00:00"
    from martspark.catalog.q_governance import change_log, second_extract
    a = scd2.scd2_apply(scd2.scd2_initial(m.stg_customers), second_extract(m.stg_customers), load)
    b = scd2.scd2_from_changes(change_log(m.stg_customers, load))
    cols = ["customer_id", "customer_sk", "valid_from", "valid_to", "is_current", "territory_id", "customer_class_id"]
    assert sorted(map(tuple, a.select(cols).collect())) == sorted(map(tuple, b.select(cols).collect()))


# ---------------------------------------------------------------- dq_bad_rows
def test_quality_evaluator_counts(spark):
    df = spark.createDataFrame(
        [("I1", 1, 0, "C1", 3, -1.0, 1.0, D(2001, 1, 1), 0), ("I1", 1, 0, "C1", 3, 1.0, 1.0, D(2001, 1, 1), 0),
         ("I2", 1, 0, None, 2, 1.0, 1.0, D(1990, 1, 1), 1), ("I3", 1, 0, "C3", 4, 1.0, None, None, 0)],
        "invoice_number string, line_item_sequence int, component_sequence int, customer_id string, sop_type int, "
        "unit_price double, unit_cost double, document_date date, is_voided int")
    cm = spark.createDataFrame([(0,), (1,), (2,)], "is_churned_flag int")
    res = {r.rule_id: (r.unexpected_count, r.success)
           for r in quality.evaluate({"sales_lines": df, "customer_monthly": cm}, quality.SALES_SUITE).collect()}
    assert res[1] == (0, True)
    assert res[3] == (1, False)       # null customer
    assert res[4] == (1, False)       # null date
    assert res[5] == (2, False)       # duplicated compound key: both rows
    assert res[6] == (1, False)       # type outside {3, 4}
    assert res[7] == (1, False)       # negative price
    assert res[8] == (0, True)        # NULL cost is not "unexpected"
    assert res[9] == (1, False)       # date out of range
    assert res[10] == (1, False)      # voided row
    assert res[11] == (1, False)


# --------------------------------------------------------------------- privacy
def test_masking(spark):
    df = spark.createDataFrame([("Juan Perez", "+1-555-0001234"), ("Solo", "12"), (None, None)], "n string, p string")
    got = [(r.a, r.b) for r in df.select(mask_name(F.col("n")).alias("a"), mask_phone(F.col("p")).alias("b")).collect()]
    assert got == [("Juan P***", "+*-***-***1234"), ("S***", "**"), (None, None)]


def test_csv_export_escapes_quotes(spark, tmp_path):
    from martspark.sources.io import write_csv
    df = spark.createDataFrame([('say "hi"', 1)], "a string, b int")
    write_csv(df.coalesce(1), str(tmp_path / "out"))
    text = "".join(p.read_text() for p in (tmp_path / "out").glob("part-*.csv"))
    assert '"say ""hi"""' in text and text.startswith('"a","b"')


# ------------------------------------------------------------ source registry
def test_binding_matches_source_registry(spark):
    from martspark.sources.binding import SOURCE_ORDER, sources_for
    from martspark.sources.schemas import schema_of
    src = sources_for(spark, "/root/testdata/sf0.001")
    for name in SOURCE_ORDER:
        got = {f.name: f.dataType for f in src[name].schema.fields}
        want = {f.name: f.dataType for f in schema_of(name).fields}
        assert got == want, name


@pytest.mark.parametrize("n", [2, 6, 31])
def test_global_ntiles_stacked_equals_windows(spark, n):
    from martspark.plans.ranking import global_ntiles
    rnd = random.Random(n)
    df = spark.createDataFrame([(f"k{i:03d}", rnd.randrange(5), Decimal(rnd.randrange(1000)) / 10) for i in range(n)],
                               "k string, a int, b decimal(10,1)")
    got = {r.k: (r.qa, r.qb) for r in global_ntiles(df, "k", (("qa", "a", True), ("qb", "b", False)), 5).collect()}
    wa = Window.orderBy(F.col("a").desc(), F.col("k"))
    wb = Window.orderBy(F.col("b").asc(), F.col("k"))
    ref = {r.k: (r.qa, r.qb) for r in df.select("k", F.ntile(5).over(wa).alias("qa"),
                                                 F.ntile(5).over(wb).alias("qb")).collect()}
    assert got == ref


# ------------------------------------------------------------------ refresh
def test_refresh_all_writes_partitioned_snapshot(spark, tmp_path):
    from martspark.mart import Mart
    from martspark.operators import facts
    from martspark.streaming.refresh import refresh_all, refresh_counts
    m = Mart(spark, "/root/testdata/sf0.001")
    snap = facts.fact_customer_monthly_snapshot(m.customer_monthly, m.dim_customer, m.dim_salesperson,
                                                m.dim_territory)
    marts = {"dim_product": m.dim_product, "snapshot": snap}
    counts = refresh_all(marts, str(tmp_path), {"snapshot": ["year_month_sk"]})
    assert counts == {r.mart: r.row_count for r in refresh_counts(marts).collect()}
    back = spark.read.parquet(str(tmp_path / "snapshot"))
    assert back.count() == counts["snapshot"]
    assert any(p.name.startswith("year_month_sk=") for p in (tmp_path / "snapshot").iterdir())


def test_nested_forms(spark):
    from martspark.mart import Mart
    from martspark.operators import directory
    m = Mart(spark, "/root/testdata/sf0.001")
    lists = {r.territory_name: r.salespeople for r in directory.salespeople_by_territory(m.fact_usd).collect()}
    pairs = directory.salespeople_by_territory_pairs(m.fact_usd).collect()
    assert sum(len(v) for v in lists.values()) == len(pairs)
    assert all(v == sorted(v) for v in lists.values())
    per = C.cohort_matrix_periods(m.fact_usd).collect()
    flat = {r.cohort_month: r for r in C.cohort_matrix(m.fact_usd).collect()}
    for r in per:
        # only months that exist; the flat form pads the rest with 0
        n = len(r.periods)
        assert [p.retention_pct for p in r.periods] == [flat[r.cohort_month][f"m{i}"] for i in range(n)]
        assert all(flat[r.cohort_month][f"m{i}"] == 0 for i in range(n, 6))
        assert r.periods[0].period == "M+0" and r.periods[0].active_users == r.total_users


# ------------------------------------------------------------------- skew
def _skewed_lines(spark):
    """Enriched-line shaped rows where one customer holds a third of all lines."""
    rnd = random.Random(11)
    rows = []
    for i in range(900):
        cust = "HOT" if i % 3 == 0 else f"C{rnd.randrange(40)}"
        d = D(2000, 1, 1) + dt.timedelta(days=rnd.randrange(500))
        t = 4 if rnd.random() < 0.2 else 3
        amt = Decimal(rnd.randrange(1, 10000)) / 100
        sign = -1 if t == 4 else 1
        rows.append((f"{'RTN' if t == 4 else 'INV'}{i // 3:05d}", cust, d, t, sign * amt, sign * amt - Decimal("0.50"),
                     sign * amt / 2, sign * amt / 2 - Decimal("0.50"), Decimal(sign)))
    return spark.createDataFrame(rows, "invoice_number string, customer_id string, document_date date, sop_type int, "
                                       "gross_sales_amount decimal(22,3), net_sales_amount decimal(22,3), "
                                       "total_cost_amount decimal(22,3), gross_profit_amount decimal(22,3), "
                                       "net_quantity decimal(22,3)")


def test_customer_monthly_with_hot_customer_matches_direct_aggregation(spark):
    lines = _skewed_lines(spark)
    got = {(r.customer_id, r.period_month): (r.total_invoices_month, r.total_returns_month, r.net_sales_month,
                                             r.cumulative_net_sales_ltv)
           for r in C.customer_monthly(lines).collect()}
    m = F.trunc("document_date", "month")
    direct = lines.groupBy("customer_id", m.alias("pm")).agg(
        F.countDistinct(F.when(F.col("sop_type") == 3, F.col("invoice_number"))).alias("i"),
        F.countDistinct(F.when(F.col("sop_type") == 4, F.col("invoice_number"))).alias("r"),
        F.sum("net_sales_amount").alias("n"))
    w = Window.partitionBy("customer_id").orderBy("pm").rowsBetween(Window.unboundedPreceding, 0)
    ref = {(r.customer_id, r.pm): (r.i, r.r, r.n, r.c)
           for r in direct.withColumn("c", F.sum("n").over(w)).collect()}
    assert got == ref


def test_document_level_shuffle_spreads_a_hot_customer(spark):
    plan = C.customer_monthly(_skewed_lines(spark))._jdf.queryExecution().executedPlan().toString()
    # the line-level shuffle is keyed by document, not by customer alone
    import re
    assert re.search(r"hashpartitioning\(customer_id#\d+, [^)]*invoice_number#\d+", plan)


def test_served_mart_gives_same_results(spark, tmp_path):
    from martspark.mart import Mart
    from martspark.operators import sales
    live = Mart(spark, "/root/testdata/sf0.001")
    served = Mart(spark, "/root/testdata/sf0.001")
    counts = served.serve_from(str(tmp_path))
    assert counts["fact_usd"] == live.fact_usd.count()
    a = sorted(map(tuple, sales.sales_trend(live.fact_usd).collect()))
    b = sorted(map(tuple, sales.sales_trend(served.fact_usd).collect()))
    assert a == b


def test_fact_sales_conserves_staged_lines(spark):
    """Σ fact = Σ staging: the dimension lookups neither drop nor multiply lines."""
    from martspark.mart import Mart
    from martspark.operators import facts
    m = Mart(spark, "/root/testdata/sf0.001")
    fact = facts.fact_sales(m.sales_lines_enriched, m.dim_customer, m.dim_product, m.dim_salesperson,
                            m.dim_territory)
    valid = (m.stg_sales_headers.where((F.col("is_voided") == 0) & F.col("sop_type").isin(3, 4))
             .select("invoice_number", "sop_type").distinct())
    lines = m.stg_sales_lines.join(valid, ["invoice_number", "sop_type"], "left_semi")
    sign = F.when(F.col("sop_type") == 4, F.lit(-1)).otherwise(F.lit(1))
    exp = lines.agg(F.count(F.lit(1)), F.sum(sign * F.col("extended_price")), F.sum(sign * F.col("quantity"))).first()
    got = fact.agg(F.count(F.lit(1)), F.sum("extended_price"), F.sum("quantity")).first()
    assert exp[0] > 0
    assert tuple(got) == tuple(exp)
    assert fact.select("sales_fact_sk").distinct().count() == got[0]


def test_scd2_from_changes_hot_customer_against_loop(spark):
    """One customer with a long change history (repeated states collapse) plus small ones."""
    from martspark.mart import Mart
    base = Mart(spark, "/root/testdata/sf0.001").stg_customers.select(*scd2.SNAPSHOT_COLS)
    proto = base.first().asDict()
    schema = base.schema.add("change_ts", "timestamp")
    t0 = dt.datetime(2020, 1, 1)
    rows = []
    for i in range(300):  # class changes every third observation
        rows.append({**proto, "customer_id": "HOT", "customer_class_id": f"K{i // 3 % 4}",
                     "change_ts": t0 + dt.timedelta(days=i)})
    for c in range(20):
        for i in range(2):
            rows.append({**proto, "customer_id": f"C{c:02d}", "customer_class_id": f"K{(c * i) % 2}",
                         "change_ts": t0 + dt.timedelta(days=c + 10 * i)})
    changes = spark.createDataFrame([tuple(r[f.name] for f in schema) for r in rows], schema)
    got = sorted((r.customer_id, r.valid_from, r.valid_to, r.is_current, r.customer_class_id)
                 for r in scd2.scd2_from_changes(changes).collect())
    exp = []
    for cid in sorted({r["customer_id"] for r in rows}):
        hist = sorted((r for r in rows if r["customer_id"] == cid), key=lambda r: r["change_ts"])
        kept = [r for k, r in enumerate(hist)
                if k == 0 or tuple(r[c] for c in scd2.CHECK_COLS) != tuple(hist[k - 1][c] for c in scd2.CHECK_COLS)]
        for k, r in enumerate(kept):
            nxt = kept[k + 1]["change_ts"] if k + 1 < len(kept) else dt.datetime(9999, 12, 31, 23, 59, 59)
            exp.append((cid, r["change_ts"], nxt, k + 1 == len(kept), r["customer_class_id"]))
    assert len([e for e in exp if e[0] == "HOT"]) == 100
    assert got == sorted(exp)


# ------------------------------------------------- churn and cohort population
def _usd(spark, rows):
    return spark.createDataFrame(rows, "customer_id string, document_date date, invoice_number string, "
                                       "net_sales_amount double, gross_profit_amount double, quantity double, "
                                       "territory_name string, customer_class_id string, salesperson_name string")


def test_lines_without_customer_are_nobodys_history(spark):
    from martspark.operators import sales
    rows = [("A", D(2001, 1, 10), "I1", 1.0, 1.0, 1.0, "t", "c", "s"), ("A", D(2001, 2, 10), "I2", 1.0, 1.0, 1.0, "t", "c", "s"),
            (None, D(2001, 1, 11), "I3", 5.0, 1.0, 1.0, "t", "c", "s")]
    f = _usd(spark, rows)
    hist = {r.year_month: r for r in C.churn_history(f).collect()}
    assert all(r.churned_customers == 0 and r.churn_rate_pct == 0.0 for r in hist.values())
    flat = C.cohort_matrix(f).collect()
    assert [(r.total_users, r.m0) for r in flat] == [(1, 100.0)]
    nested = C.cohort_matrix_periods(f).collect()
    assert [[(p.period, p.active_users) for p in r.periods] for r in nested] == [[("M+0", 1), ("M+1", 1)]]
    people = _usd(spark, rows[:1])
    k = sales.kpi_summary(f, people, D(2001, 3, 1)).first()
    assert (k.active_customers, k.churned_customers, k.total_net_sales) == (1, 0, 7.0)
    assert k.net_sales == k.total_net_sales and k.churned_customers_count == 0


def test_churn_rate_counts_invoices_of_the_churn_base(spark):
    cols = ("invoice_number string, line_item_sequence int, component_sequence int, customer_id string, document_date date, "
            "sop_type int, net_quantity decimal(19,4), gross_sales_amount decimal(19,2), net_sales_amount decimal(19,2), "
            "total_cost_amount decimal(19,2), gross_profit_amount decimal(19,2)")

    def line(doc, customer, day, kind=3):
        x = __import__("decimal").Decimal(1)
        return (doc, 1, 0, customer, day, kind, x, x, x, x, x)

    lines = spark.createDataFrame([
        line("I1", "A", D(2001, 1, 20)), line("R1", "A", D(2001, 4, 10), 4),  # the return is no purchase
        line("I2", "X", D(2001, 1, 20))], cols)                                # X is not in the base
    base = spark.createDataFrame([("A",)], "customer_id string")
    out = {r.period_month: r for r in C.churn_rate_monthly(lines, base, D(2001, 8, 2)).collect()}
    assert out[D(2001, 5, 1)].churned_customers == 1 and out[D(2001, 5, 1)].active_start_month == 1
    assert sum(r.churned_customers for r in out.values()) == 1
    assert max(r.active_start_month for r in out.values()) == 1


# ------------------------------------------------------------ staging and plans
def test_building_a_plan_runs_no_job(spark):
    from martspark.sources.binding import Sources
    src = Sources(spark, "/root/testdata/sf0.001")
    sc = spark.sparkContext
    sc.setJobGroup("plan-only", "plan-only")
    for name in ("SOP30300", "IV10200"):
        assert src[name].columns
    jobs = sc.statusTracker().getJobIdsForGroup("plan-only")
    sc.setLocalProperty("spark.jobGroup.id", None)
    # reading Parquet footers is a job of its own; lineitem, orders and part, then lineitem
    assert len(jobs) <= 4


def test_bucketed_row_number_equals_window(spark):
    from pyspark.sql import Window
    from martspark.plans.ranking import bucketed_row_number
    df = spark.range(500).select((F.col("id") % 3).alias("k"), (F.col("id") % 7).alias("d"), "id").unionByName(
        spark.createDataFrame([(None, None, 900), (None, 1, 901)], "k long, d long, id long"))
    got = bucketed_row_number(df, [F.col("k")], ["d", "id"], "rn")
    want = df.withColumn("rn", F.row_number().over(Window.partitionBy("k").orderBy("d", "id")))
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_staging_folders_are_removed(spark, tmp_path):
    import os

    from martspark.plans import stage as st
    with st.staging(spark):
        path = st.stage(spark.range(3))._staged_path
        local = path.replace("file:", "")
        assert os.path.isdir(local)
    assert not os.path.exists(local)


def test_cluster_without_shared_folder_is_an_error():
    from martspark.session import checkpoint_dir

    class Conf:
        def get(self, key, default=None):
            return {"spark.master": "spark://host:7077"}.get(key, default)

    class Remote:
        conf = Conf()

        @property
        def sparkContext(self):
            raise RuntimeError("no context")

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        checkpoint_dir(Remote())


def test_suite_from_json(spark):
    import json
    text = json.dumps({"expectations": [
        {"expectation_type": "expect_column_values_to_not_be_null", "kwargs": {"column": "a"}, "meta": {"dimension": "Completeness"}},
        {"expectation_type": "expect_compound_columns_to_be_unique", "kwargs": {"column_list": ["a", "b"]}},
        {"expectation_type": "expect_column_values_to_be_in_set", "kwargs": {"column": "b", "value_set": [1, 2]}},
        {"expectation_type": "expect_column_values_to_be_between", "kwargs": {"column": "b", "min_value": 2}},
        {"expectation_type": "expect_table_row_count_to_be_between", "kwargs": {"min_value": 1, "max_value": 2}}]})
    rules = quality.load_suite(text, "t")
    df = spark.createDataFrame([(1, 1), (1, 1), (None, 3)], "a int, b int")
    got = {r.rule_id: (r.unexpected_count, r.success, r.dimension) for r in quality.evaluate({"t": df}, rules).collect()}
    assert got == {1: (1, False, "Completeness"), 2: (2, False, "General"), 3: (1, False, "General"),
                   4: (2, False, "General"), 5: (0, False, "General")}
    with pytest.raises(ValueError, match="unknown type"):
        quality.load_suite('{"expectations": [{"expectation_type": "expect_magic"}]}', "t")


def test_rate_fallback_without_rates(spark):
    from martspark.operators import fx
    rates = spark.createDataFrame([], "exch_date date, xchg_rate double")
    assert spark.range(1).select(fx.latest_rate(rates)).first()[0] == 1.0


def test_referential_sees_orphans(spark):
    fact = spark.createDataFrame([("a", 1), ("b", None), ("zz", 9)], "x string, y int")
    d1 = spark.createDataFrame([("a",), ("b",)], "k string")
    d2 = spark.createDataFrame([(1,)], "k int")
    got = {(r.table_name, r.foreign_key): (r.fact_rows, r.orphan_rows) for r in quality.referential(
        {"f": (fact, {"x": (d1, "k"), "y": (d2, "k")})}).collect()}
    assert got == {("f", "x"): (3, 1), ("f", "y"): (3, 1)}


def test_referential_counts_key_values_and_reads_a_dimension_once(spark, tmp_path):
    spark.createDataFrame([("a",), ("a",), (None,)], "k string").write.parquet(f"{tmp_path}/dim")
    dim = spark.read.parquet(f"{tmp_path}/dim")
    many = spark.range(1000).select(F.when(F.col("id") < 900, "a").when(F.col("id") < 990, "zz").alias("x"),
                                    F.lit("a").alias("y"))
    out = quality.referential({"f": (many, {"x": (dim, "k"), "y": (dim, "k")}),
                               "empty": (many.where("false"), {"y": (dim, "k")})})
    assert [tuple(r) for r in out.collect()] == [("f", "x", 1000, 90, False), ("f", "y", 1000, 0, True),
                                                 ("empty", "y", 0, 0, True)]
    # the dimension is not computed again for every key, and rows of equal keys are one before the join
    assert not any("/dim/" in f for f in out.inputFiles())
    plan = out._jdf.queryExecution().optimizedPlan().toString().split("\n")
    joins = [i for i, line in enumerate(plan) if "Join LeftOuter" in line]
    assert joins and all("Aggregate [" in plan[i + 1] for i in joins)


@pytest.mark.parametrize("name", ["dq_expectations", "dq_by_dimension", "dq_column_tests", "dq_contract",
                                  "dq_referential", "filter_facets", "refresh_counts"])
def test_shared_marts_are_computed_once(spark, name):
    from martspark.catalog import QUERIES
    plan = QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    # after staging, the result's plan joins lines to headers at most once
    assert sum("Join Inner" in x and "SOPTYPE" in x for x in plan.split("\n")) <= 1


def test_one_history_join(spark):
    from martspark.catalog import QUERIES
    plan = QUERIES["scd2_apply"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join FullOuter") == 1


@pytest.mark.parametrize("name", ["sales_slice_quarter", "sales_slice_week", "ar_kpis", "churn_rate_monthly"])
def test_no_expand(spark, name):
    from martspark.catalog import QUERIES
    assert "Expand" not in QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()


def test_contract_reports_a_missing_column(spark):
    fact = spark.createDataFrame([("k1", "d1", 1, 0, "c", "p", 20200101), ("k2", "d2", 1, 0, None, "p", 20200101)],
                                 "sales_fact_sk string, invoice_number string, line_item_sequence int, component_sequence int, "
                                 "customer_sk string, product_sk string, document_date_sk int")
    got = {r.rule_id: (r.unexpected_count, r.success) for r in quality.contract(fact).collect()}
    assert got == {0: (1, False), 1: (0, True), 2: (0, True), 3: (0, True), 4: (1, False), 5: (0, True), 6: (0, True),
                   7: (2, False)}
