"""Sales lines: the model-layer enriched lines (M06) and the service-layer USD
fact (M03–M05), its filters (V01) and the sales aggregates (V02–V05, K06).

Two net-sales formulas exist and are never mixed (SURVEY D2):

* model layer (``sales_lines_enriched``): ``sign·extended − markdown`` in local
  currency, decimal arithmetic;
* service layer (``service_sales_fact``): ``((extended − markdown) / rate)·sign``
  in USD with the original USD price when the document is in USD, double
  arithmetic rounded to cents.

Physical plan: header ⋈ line is the one large join (shuffle on the document
key, or co-located when both sides are bucketed by it); every other lookup is a
broadcast of bounded master data or a size-checked join left to AQE.
Aggregates are algebraic (partial aggregation before the shuffle), so a hot
customer or territory does not concentrate rows in one task.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import labels as L
from ..functions.numeric import ratio_or, rnd
from ..plans.broadcast import small
from ..plans.stage import stage
from . import fx
from .org import resolve_sales_org

ALL = "ALL"


def _date(value) -> Column:
    if isinstance(value, Column):
        return value
    if isinstance(value, str):
        value = dt.date.fromisoformat(value)
    return F.lit(value)


def direction(sop_type: Column) -> Column:
    """+1 for invoices, −1 for returns (decimal(2,1) like the SQL literal)."""
    return F.when(sop_type == 4, F.lit(-1.0).cast("decimal(2,1)")).otherwise(F.lit(1.0).cast("decimal(2,1)"))


def dated_from(start: Column) -> Column:
    """Lines of documents dated from ``start`` on.  A line repeats its document's date, so the line scan
    can be cut too; a line without a date is kept and left to its header."""
    return (F.col("DOCDATE") >= start) | F.col("DOCDATE").isNull()


def date_sk(d: Column) -> Column:
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


# --------------------------------------------------------------------------- M06
def sales_lines_enriched(headers: DataFrame, lines: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """invoice/return lines joined to their non-voided header, signed metrics.

    ``headers``/``lines`` are the staging frames (T05, T06).  The item join of
    the model is not reproduced: it reads no column and could only duplicate
    lines if the item key were not unique (G03 tests that it is).  ``carry``
    names further header columns to pass through.
    """
    return line_metrics(document_lines(headers, lines, carry), carry)


def with_unknown_org(rows: DataFrame) -> DataFrame:
    """Missing salesperson and territory ids as those of the unknown members."""
    return rows.withColumns({"salesperson_id": F.coalesce("salesperson_id", F.lit(L.UNKNOWN_SP)),
                             "territory_id": F.coalesce("territory_id", F.lit(L.UNKNOWN_TERR))})


def document_lines(headers: DataFrame, lines: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """The join of M06 alone: source columns, narrower than the metrics where they still have to be shuffled."""
    h = headers.where((F.col("is_voided") == 0) & F.col("sop_type").isin(3, 4)).select(
        F.col("invoice_number").alias("h_invoice_number"), F.col("sop_type").alias("h_sop_type"),
        "document_date", "gl_post_date", "customer_id", "salesperson_id", "territory_id", "currency_id",
        "document_type_name", "doc_id", *carry)
    lcols = lines.where(F.col("sop_type").isin(3, 4)).select(
        "invoice_number", "sop_type", "line_item_sequence", "component_sequence", "item_number", "uofm",
        "location_code", "quantity", "unit_price", "extended_price", "unit_cost", "extended_cost", "markdown_amount")
    j = lcols.join(h, (lcols["invoice_number"] == h["h_invoice_number"]) & (lcols["sop_type"] == h["h_sop_type"]))
    return j.drop("h_invoice_number", "h_sop_type")


def line_metrics(j: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """The columns of M06 of joined lines (``document_lines``)."""
    sign = direction(F.col("sop_type"))
    gross = sign * F.col("extended_price")
    cost = sign * F.col("extended_cost")
    net = gross - F.coalesce(F.col("markdown_amount"), F.lit(0).cast("decimal(19,2)"))
    profit = net - cost
    margin = F.when(net != 0, (profit * 100).cast("double") / net.cast("double")).otherwise(F.lit(0.0))
    return j.select(
        "invoice_number", "line_item_sequence", "component_sequence",
        "document_date", "gl_post_date",
        date_sk(F.col("document_date")).alias("document_date_sk"),
        date_sk(F.col("gl_post_date")).alias("gl_post_date_sk"),
        "customer_id", "item_number",
        F.coalesce("salesperson_id", F.lit(L.UNKNOWN_SP)).alias("salesperson_id"),
        F.coalesce("territory_id", F.lit(L.UNKNOWN_TERR)).alias("territory_id"),
        "currency_id", "uofm", "location_code", "sop_type", "document_type_name", "doc_id",
        sign.alias("direction_multiplier"),
        (sign * F.col("quantity")).alias("net_quantity"),
        "unit_price",
        gross.alias("gross_sales_amount"),
        "unit_cost",
        cost.alias("total_cost_amount"),
        "markdown_amount",
        net.alias("net_sales_amount"),
        profit.alias("gross_profit_amount"),
        margin.alias("gross_profit_margin_pct"),
        *carry,
    )


# ------------------------------------------------------------------- M03–M05
def service_sales_fact(sop30200: DataFrame, sop30300: DataFrame, rm00101: DataFrame, rm00301: DataFrame,
                       rm00303: DataFrame, iv00101: DataFrame, rates: DataFrame, as_of,
                       months_back: int = 36) -> DataFrame:
    """M03 (with M01, M02, M04, M05): USD sales lines of the analytics service.

    Invoices and returns of non-voided documents dated in the trailing
    ``months_back`` months before ``as_of`` (the window predicate is pushed into
    both scans), header ⋈ line on (type, number), names resolved by M04,
    rates by the as-of calendar join, amounts in USD rounded to cents.
    """
    start = F.add_months(_date(as_of), -months_back)
    h = sop30200.where(F.col("SOPTYPE").isin(3, 4) & (F.col("VOIDSTTS") == 0) & (F.col("DOCDATE") >= start))
    h = h.select(
        F.col("SOPTYPE").alias("sop_type"), F.trim("SOPNUMBE").alias("h_key"),
        F.rtrim("SOPNUMBE").alias("invoice_number"), F.col("DOCDATE").cast("date").alias("document_date"),
        F.col("GLPOSTDT").cast("date").alias("gl_post_date"), "CUSTNMBR", "CUSTNAME", "SLPRSNID", "SALSTERR", "CURNCYID", "XCHGRATE")
    line = sop30300.where(F.col("SOPTYPE").isin(3, 4) & dated_from(start)).select(
        F.col("SOPTYPE").alias("l_type"), F.trim("SOPNUMBE").alias("l_key"), "LNITMSEQ", "ITEMNMBR", "ITEMDESC",
        "QUANTITY", "UNITPRCE", "XTNDPRCE", "OXTNDPRC", "UNITCOST", "EXTDCOST", "MRKDNAMT")
    # names and classes are looked up by documents and narrow lines, before these meet
    h = resolve_sales_org(h, rm00101, rm00301, rm00303)
    items = small(iv00101.select(F.trim("ITEMNMBR").alias("i_key"), F.rtrim("ITMCLSCD").alias("i_class")))
    line = line.join(items, F.trim(line["ITEMNMBR"]) == items["i_key"], "left")
    j = h.join(line, (h["sop_type"] == line["l_type"]) & (h["h_key"] == line["l_key"]))
    base = j.select(
        "sop_type", "invoice_number", F.col("LNITMSEQ").alias("line_item_sequence"), "document_date",
        "gl_post_date", F.rtrim("CUSTNMBR").alias("customer_id"), F.rtrim("CUSTNAME").alias("customer_name"),
        "customer_class_id", "salesperson_name", "salesperson_id", "territory_name", "territory_id",
        F.rtrim("ITEMNMBR").alias("item_number"), F.rtrim("ITEMDESC").alias("item_description"),
        F.coalesce(F.nullif(F.col("i_class"), F.lit("")), F.lit(L.SERVICE_GENERAL)).alias("category"),
        F.rtrim("CURNCYID").alias("currency_id"),
        F.col("XCHGRATE").cast("double").alias("header_rate"),
        F.col("QUANTITY").cast("double").alias("quantity"),
        F.col("UNITPRCE").cast("double").alias("unit_price_vef"),
        F.col("XTNDPRCE").cast("double").alias("extended_price_vef"),
        F.col("OXTNDPRC").cast("double").alias("orig_extended_price"),
        F.col("UNITCOST").cast("double").alias("unit_cost_vef"),
        F.col("EXTDCOST").cast("double").alias("extended_cost_vef"),
        F.coalesce(F.col("MRKDNAMT"), F.lit(0).cast("decimal(19,2)")).cast("double").alias("markdown_vef"),
    )
    withfx = fx.asof_join(base, rates, "document_date")
    rate = fx.effective_rate(F.col("header_rate"), F.col("xchg_rate"))
    sign = F.when(F.col("sop_type") == 4, F.lit(-1.0)).otherwise(F.lit(1.0))
    is_usd = (F.trim("currency_id") == F.lit("USD")) & (F.col("orig_extended_price") > 0)
    net_raw = F.when(is_usd, F.col("orig_extended_price") * sign).otherwise(
        ((F.col("extended_price_vef") - F.col("markdown_vef")) / F.col("effective_rate")) * sign)
    cost_raw = (F.col("extended_cost_vef") / F.col("effective_rate")) * sign
    out = withfx.withColumn("effective_rate", rate).withColumn("direction_multiplier", sign)
    return out.select(
        *[c for c in out.columns if c != "quantity"],
        (F.col("quantity") * sign).alias("quantity"),
        F.when(F.col("sop_type") == 4, F.lit(L.DOC_LABEL_RETURN)).otherwise(F.lit(L.DOC_LABEL_INVOICE)).alias("doc_type_desc"),
        rnd(net_raw, 2).alias("net_sales_amount"),
        rnd(cost_raw, 2).alias("extended_cost_usd"),
        rnd(net_raw - cost_raw, 2).alias("gross_profit_amount"),
        F.date_format("document_date", "yyyy-MM").alias("year_month"),
    )


# ----------------------------------------------------------------------- V01
def apply_filters(df: DataFrame, territory: str | None = None, customer_class: str | None = None,
                  salesperson: str | None = None, start_date=None, end_date=None) -> DataFrame:
    """``ALL``/None means no filter; date bounds are inclusive."""
    if territory and territory != ALL:
        df = df.where(F.col("territory_name") == territory)
    if customer_class and customer_class != ALL:
        df = df.where(F.col("customer_class_id") == customer_class)
    if salesperson and salesperson != ALL:
        df = df.where(F.col("salesperson_name") == salesperson)
    if start_date:
        df = df.where(F.col("document_date") >= _date(start_date))
    if end_date:
        df = df.where(F.col("document_date") <= _date(end_date))
    return df


def money_sum(c: str, scale: int = 2) -> Column:
    """Exact sum of values already rounded to ``scale`` places (order-independent)."""
    return F.sum(F.col(c).cast(f"decimal(30,{scale})"))


# ----------------------------------------------------------------------- V02
def kpi_summary(fact: DataFrame, customers: DataFrame, as_of, churn_days: int = 90,
                territory=None, customer_class=None, salesperson=None, start_date=None, end_date=None) -> DataFrame:
    """One-row KPI summary.  The customers-in-scope count ignores the date
    filters (D19); the activity split uses each customer's last purchase."""
    s = apply_filters(fact, territory, customer_class, salesperson, start_date, end_date)
    c = apply_filters(customers, territory, customer_class, salesperson)
    cutoff = F.date_sub(_date(as_of), churn_days)
    # one pass over the lines: exact per-document partial sums, staged once and
    # read by both the totals and the per-customer activity branch
    docs = stage(s.groupBy("customer_id", "invoice_number").agg(
        F.sum(F.col("net_sales_amount").cast("decimal(30,2)")).alias("net"),
        F.sum(F.col("gross_profit_amount").cast("decimal(30,2)")).alias("gp"),
        F.sum(F.col("quantity").cast("decimal(30,4)")).alias("qty"),
        F.max("document_date").alias("last_date")))
    # documents without a customer count in the totals, but are nobody's activity
    last = docs.where(F.col("customer_id").isNotNull()).groupBy("customer_id").agg(
        F.max("last_date").alias("last_purchase"))
    activity = last.agg(
        F.count_if(F.col("last_purchase") >= cutoff).alias("active_customers"),
        F.count_if(F.col("last_purchase") < cutoff).alias("churned_customers"),
    )
    totals = docs.agg(
        F.sum("net").cast("double").alias("total_net_sales"),
        F.sum("gp").cast("double").alias("total_gross_profit"),
        F.countDistinct("invoice_number").alias("total_orders"),
        F.sum("qty").cast("double").alias("total_units"),
    )
    scope = c.agg(F.count(F.lit(1)).alias("total_customers_in_scope"))
    # three one-row frames side by side: scalar subqueries, no join
    act = activity.select(F.struct("active_customers", "churned_customers")).scalar()
    row = totals.select(
        "*",
        act.getField("active_customers").alias("active_customers"),
        act.getField("churned_customers").alias("churned_customers"),
        scope.select("total_customers_in_scope").scalar().alias("total_customers_in_scope"),
    )
    ns, gp, orders = F.col("total_net_sales"), F.col("total_gross_profit"), F.col("total_orders")
    base = F.col("active_customers") + F.col("churned_customers")
    return row.select(
        "total_net_sales", "total_gross_profit",
        ratio_or(gp * 100, ns, ns > 0, 0.0, 2).alias("gross_margin_pct"),
        "total_orders", "total_units",
        ratio_or(ns, orders, orders > 0, 0.0, 2).alias("average_order_value"),
        "active_customers", "churned_customers",
        ratio_or(F.col("churned_customers") * 100, base, base > 0, 0.0, 2).alias("churn_rate_pct"),
        ratio_or(gp, base, base > 0, 0.0, 2).alias("average_ltv_gross_profit"),
        "total_customers_in_scope",
        ns.alias("net_sales"), gp.alias("gross_profit"), F.col("churned_customers").alias("churned_customers_count"),
        ratio_or(gp, base, base > 0, 0.0, 2).alias("average_customer_ltv"),
    )


# ------------------------------------------------------------------- V03–V05
def sales_trend(fact: DataFrame, **filters) -> DataFrame:
    """Monthly net sales, profit, distinct documents and margin %."""
    s = apply_filters(fact, **filters)
    g = s.groupBy("year_month").agg(
        F.round(money_sum("net_sales_amount"), 2).cast("double").alias("net_sales"),
        F.round(money_sum("gross_profit_amount"), 2).cast("double").alias("gross_profit"),
        F.countDistinct("invoice_number").alias("orders_count"),
    )
    return g.select(
        "year_month", "net_sales", "gross_profit", "orders_count",
        ratio_or(F.col("gross_profit") * 100, F.col("net_sales"), F.col("net_sales") > 0, 0.0, 2).alias("gross_margin_pct"),
        F.col("year_month").alias("month"), F.col("net_sales").alias("sales"),
    )


def sales_by_territory(fact: DataFrame, **filters) -> DataFrame:
    """Sales by territory name, largest first."""
    s = apply_filters(fact, **filters)
    g = s.groupBy("territory_name").agg(
        money_sum("net_sales_amount").cast("double").alias("net_sales"),
        money_sum("gross_profit_amount").cast("double").alias("gross_profit"),
        F.countDistinct("invoice_number").alias("orders_count"),
    )
    return g.select("territory_name", "net_sales", "gross_profit", "orders_count",
                    F.col("net_sales").alias("sales")).orderBy(F.desc("net_sales"), "territory_name")


def sales_by_category(fact: DataFrame, **filters) -> DataFrame:
    """Sales and units by item category, largest first."""
    s = apply_filters(fact, **filters)
    g = s.groupBy("category").agg(
        money_sum("net_sales_amount").cast("double").alias("net_sales"),
        money_sum("quantity", 4).cast("double").alias("units_sold"),
    )
    return g.select("category", "net_sales", "units_sold", F.col("category").alias("category_id"),
                    F.col("net_sales").alias("sales")).orderBy(F.desc("net_sales"), "category")


# ----------------------------------------------------------------------- K06
GRAINS = ("year", "quarter", "month", "week", "day")


def with_customer_cuts(fact: DataFrame, customers: DataFrame, credit_steps=(0, 25_000, 100_000)) -> DataFrame:
    """K06 cuts: ``credit_limit_band`` (the customer's limit among ``credit_steps``)
    and ``cohort_age_months`` (months from the customer's first sale to the line)."""
    limit = F.coalesce(F.col("credit_limit_amount").cast("double"), F.lit(0.0))
    band = F.lit(f"<= {credit_steps[0]}")
    for lo, hi in zip(credit_steps, [*credit_steps[1:], None], strict=True):
        band = F.when(limit > lo, f"> {lo}" if hi is None else f"{lo}-{hi}").otherwise(band)
    c = small(customers.select(F.col("customer_id").alias("_c"), band.alias("credit_limit_band")))
    born = fact.where(F.col("customer_id").isNotNull()).groupBy(F.col("customer_id").alias("_b")).agg(
        F.min("document_date").alias("_first"))
    j = fact.join(c, fact["customer_id"] == c["_c"], "left").join(born, F.col("customer_id") == F.col("_b"), "left")
    age = ((F.year("document_date") - F.year("_first")) * 12 + F.month("document_date") - F.month("_first")).cast("int")
    return j.select(*[F.col(x) for x in fact.columns], "credit_limit_band", age.alias("cohort_age_months"))


def sales_slice(fact: DataFrame, grain: str = "quarter", dims: tuple[str, ...] = ("territory_name",),
                date_col: str = "document_date") -> DataFrame:
    """Net sales, profit, documents, units by a calendar grain × dimensions.

    ``grain`` is one of year/quarter/month/week/day (week starts Monday);
    ``date_col`` selects the document or the posting date (``gl_post_date``).
    Lines are summed per document first, so only customers need a distinct count.
    """
    if grain not in GRAINS:
        raise ValueError(f"grain must be one of {GRAINS}")
    period = F.date_trunc(grain, F.col(date_col)).cast("date").alias("period_start")
    docs = fact.groupBy(period, *dims, "invoice_number").agg(
        F.sum(F.col("net_sales_amount").cast("decimal(30,2)")).alias("net"),
        F.sum(F.col("gross_profit_amount").cast("decimal(30,2)")).alias("gp"),
        F.sum(F.col("quantity").cast("decimal(30,4)")).alias("qty"),
        F.max("customer_id").alias("customer_id"))  # a document has one customer
    return docs.groupBy("period_start", *dims).agg(
        F.sum("net").cast("double").alias("net_sales"),
        F.sum("gp").cast("double").alias("gross_profit"),
        F.count("invoice_number").alias("orders_count"),
        F.sum("qty").cast("double").alias("units"),
        F.countDistinct("customer_id").alias("customers_count"),
    )
