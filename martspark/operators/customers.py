"""Customer analytics: lifetime summary (M07), customer × month history (M08,
dense M09), cohorts (A01, V07), churn (V06, K01, K02) and LTV (K03–K05).

Scale notes
* Every window is partitioned by customer and ordered by month, so one task
  holds at most one customer's months (≤ 12 per year), whatever the skew of
  lines per customer; the per-customer month rows come out of an algebraic
  aggregate (partial aggregation before the shuffle).
* The dense history (M09) fills the gaps between a customer's months with
  ``sequence`` inside the customer partitioning — never a customers × months
  cross join, and no spine ⋈ months join.
* Month-level frames (distinct months present, cohorts) are bounded by the
  calendar; they are the only inputs of unpartitioned windows and broadcasts.
* Churn history (V06) is a bounded explode: a purchase on day d counts for the
  ≤ 4 month targets t with t − 90 ≤ d ≤ t (SURVEY D10), followed by a distinct
  count, instead of one scan of all sales per month.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import labels as L
from ..functions.numeric import ratio_or, rnd, safe_div
from ..plans.broadcast import bounded
from ..plans.stage import stage
from .sales import _date, apply_filters


def month_index(d: Column) -> Column:
    """Calendar month number (year·12 + month) for boundary-counting month diffs."""
    return F.year(d) * 12 + F.month(d)


def month_start(d: Column) -> Column:
    return F.trunc(d, "month")


def _zero_dec(scale: int = 2) -> Column:
    return F.lit(0).cast(f"decimal(19,{scale})")


# ----------------------------------------------------------------------- M07
def customer_orders_summary(enriched: DataFrame, customers: DataFrame, as_of, churn_days: int = 90) -> DataFrame:
    """Lifetime totals per customer; customers without sales are kept."""
    docs = _document_totals(enriched, [])
    agg = docs.groupBy("customer_id").agg(
        F.min("doc_first").alias("first_purchase"),
        F.max("doc_last").alias("last_purchase_date"),
        F.count_if(F.col("has_invoice")).alias("n_inv"),
        F.count_if(F.col("has_return")).alias("n_ret"),
        F.count("invoice_number").alias("n_orders"),
        F.sum("doc_gross").alias("gross"),
        F.sum("doc_returns").alias("returns"),
        F.sum("doc_net").alias("net"),
        F.sum("doc_cogs").alias("cogs"),
        F.sum("doc_gp").alias("gp"),
        F.sum("doc_units").alias("units"),
    )
    c = customers.select("customer_id", "customer_name", "customer_class_id", "salesperson_id", "territory_id",
                         "credit_limit_amount", "is_inactive", "created_at")
    j = c.join(agg, "customer_id", "left")
    net0 = F.coalesce("net", F.lit(0))
    gp0 = F.coalesce("gp", F.lit(0))
    days = F.datediff(_date(as_of), F.col("last_purchase_date"))
    return j.select(
        "customer_id", "customer_name", "customer_class_id", "salesperson_id", "territory_id", "credit_limit_amount",
        F.col("is_inactive").alias("is_inactive_in_source"),
        F.coalesce(F.col("first_purchase"), F.col("created_at").cast("date")).alias("first_purchase_date"),
        "last_purchase_date",
        F.coalesce("n_inv", F.lit(0)).alias("total_invoices_count"),
        F.coalesce("n_ret", F.lit(0)).alias("total_returns_count"),
        F.coalesce("n_orders", F.lit(0)).alias("total_orders_count"),
        F.coalesce("gross", F.lit(0)).alias("total_gross_revenue"),
        F.coalesce("returns", F.lit(0)).alias("total_returns_amount"),
        net0.alias("total_net_revenue"),
        F.coalesce("cogs", F.lit(0)).alias("total_cogs"),
        gp0.alias("historical_ltv_gross_profit"),
        F.coalesce("units", F.lit(0)).alias("total_units_purchased"),
        rnd(safe_div(net0, F.col("n_orders")), 2).alias("average_order_value"),
        rnd(safe_div(gp0 * 100, F.col("net")), 2).alias("historical_gross_margin_pct"),
        F.when(F.col("last_purchase_date").isNotNull(), days).alias("days_since_last_purchase"),
        F.when(F.col("last_purchase_date").isNull(), F.lit(L.CHURN_NEVER))
         .when(days > churn_days, F.lit(L.CHURN_CHURNED))
         .otherwise(F.lit(L.CHURN_ACTIVE)).alias("current_churn_status"),
    )


# ------------------------------------------------------------------ M08 / M09
# Line columns that the customer aggregates read.
MONTH_INPUTS = ("customer_id", "invoice_number", "sop_type", "document_date", "gross_sales_amount", "net_sales_amount",
                "total_cost_amount", "gross_profit_amount", "net_quantity")


def _document_totals(enriched: DataFrame, extra_keys: list) -> DataFrame:
    """Level 1 of the customer aggregates: one row per (customer, [month], document).

    Distinct-document counts then become plain counts of these rows (no
    ``Expand`` of the lines for several distinct aggregates), and the shuffle is
    keyed by document, so a customer with a third of all lines is spread over
    every task; level 2 (per customer or customer-month) shuffles only
    document-level partial sums.
    """
    with_invoice = F.col("invoice_number").isNotNull()
    return enriched.groupBy("customer_id", *extra_keys, "invoice_number").agg(
        F.max((F.col("sop_type") == 3) & with_invoice).alias("has_invoice"),
        F.max((F.col("sop_type") == 4) & with_invoice).alias("has_return"),
        F.sum("gross_sales_amount").alias("doc_gross"),
        F.sum(F.when(F.col("sop_type") == 4, F.abs("gross_sales_amount")).otherwise(_zero_dec())).alias("doc_returns"),
        F.sum("net_sales_amount").alias("doc_net"),
        F.sum("total_cost_amount").alias("doc_cogs"),
        F.sum("gross_profit_amount").alias("doc_gp"),
        F.sum("net_quantity").alias("doc_units"),
        F.min("document_date").alias("doc_first"),
        F.max("document_date").alias("doc_last"),
    )


def document_months(enriched: DataFrame) -> DataFrame:
    """Totals of every (customer, month, document)."""
    return _document_totals(enriched, [month_start(F.col("document_date")).alias("period_month")])


def merged_documents(totals: DataFrame) -> DataFrame:
    """Totals of the same (customer, month, document) from several loads as one, of the same types."""
    of = {"has_invoice": F.max, "has_return": F.max, "doc_first": F.min, "doc_last": F.max}
    keys = ["customer_id", "period_month", "invoice_number"]
    kinds = dict(totals.dtypes)
    return totals.groupBy(*keys).agg(*[of.get(c, F.sum)(c).cast(kinds[c]).alias(c)
                                       for c in totals.columns if c not in keys])


def _monthly_sales(enriched: DataFrame) -> DataFrame:
    return months_of_documents(document_months(enriched))


def months_of_documents(docs: DataFrame) -> DataFrame:
    """Customer × month aggregates of document totals."""
    return docs.groupBy("customer_id", "period_month").agg(
        F.count_if(F.col("has_invoice")).alias("total_invoices_month"),
        F.count_if(F.col("has_return")).alias("total_returns_month"),
        F.sum("doc_gross").alias("gross_sales_month"),
        F.sum("doc_returns").alias("returns_amount_month"),
        F.sum("doc_net").alias("net_sales_month"),
        F.sum("doc_cogs").alias("total_cogs_month"),
        F.sum("doc_gp").alias("gross_profit_month"),
        F.max("doc_last").alias("last_purchase_date_month"),
        F.min("doc_first").alias("first_purchase_date_month"),
    )


def _with_first_dates(monthly: DataFrame) -> DataFrame:
    """Cohort month and first purchase per customer from its month rows (a
    window over the customer's months, no second scan of the lines)."""
    w = Window.partitionBy("customer_id")
    return monthly.select("*", F.min("period_month").over(w).alias("cohort_month"),
                          F.min("first_purchase_date_month").over(w).alias("first_purchase_date"))


def _history_columns(m: DataFrame, churn_days: int) -> DataFrame:
    w = Window.partitionBy("customer_id").orderBy("period_month").rowsBetween(Window.unboundedPreceding, 0)
    m = m.select(
        "*",
        F.sum("net_sales_month").over(w).alias("cumulative_net_sales_ltv"),
        F.sum("gross_profit_month").over(w).alias("cumulative_gross_profit_ltv"),
        F.max("last_purchase_date_month").over(w).alias("cumulative_last_purchase_date"),
    )
    days = F.datediff(F.last_day("period_month"), F.col("cumulative_last_purchase_date"))
    return m.select(
        "customer_id", "period_month",
        (F.year("period_month") * 10000 + F.month("period_month") * 100 + 1).cast("int").alias("year_month_sk"),
        "cohort_month", "first_purchase_date", "total_invoices_month", "total_returns_month", "gross_sales_month",
        "returns_amount_month", "net_sales_month", "total_cogs_month", "gross_profit_month",
        "cumulative_net_sales_ltv", "cumulative_gross_profit_ltv", "cumulative_last_purchase_date",
        days.alias("days_since_last_purchase_at_month_end"),
        F.when(F.col("total_invoices_month") > 0, 1).otherwise(0).alias("active_month_flag"),
        F.when(F.col("period_month") == F.col("cohort_month"), 1).otherwise(0).alias("is_new_customer_flag"),
        F.when(days > churn_days, 1).otherwise(0).alias("is_churned_flag"),
    )


def customer_monthly(enriched: DataFrame, churn_days: int = 90) -> DataFrame:
    """One row per customer and month with sales lines, running LTV."""
    return history_of_months(_monthly_sales(enriched), churn_days)


def history_of_months(months: DataFrame, churn_days: int = 90) -> DataFrame:
    """M08 from customer × month aggregates of whole customers."""
    return _history_columns(_with_first_dates(months), churn_days)


def customer_monthly_dense(enriched: DataFrame, as_of, churn_days: int = 90) -> DataFrame:
    """Every month from the customer's cohort month to the ``as_of`` month.

    Months without lines carry zero metrics, so running LTV stays flat, days
    since the last purchase grow and the churn flag can become 1 (D7).
    """
    last_month = month_start(_date(as_of))
    monthly = _with_first_dates(_monthly_sales(enriched).where(F.col("period_month") <= last_month))
    # gap filling instead of spine ⋈ months: each month with lines also emits the
    # empty months up to the customer's next month with lines (or the as-of
    # month).  Everything stays in the customer partitioning of the first
    # window, so no join and no further shuffle is needed.
    w = Window.partitionBy("customer_id").orderBy("period_month")
    until = F.coalesce(F.add_months(F.lead("period_month").over(w), -1), last_month)
    g = monthly.withColumn("_until", until)
    g = g.select("*", F.explode(F.sequence(F.col("period_month"), F.col("_until"), F.expr("interval 1 month")))
                 .alias("_m"))
    own = F.col("_m") == F.col("period_month")
    filled = g.select(
        "customer_id", F.col("_m").alias("period_month"), "cohort_month", "first_purchase_date",
        *[F.when(own, F.col(c)).otherwise(F.lit(0).cast("bigint")).alias(c)
          for c in ("total_invoices_month", "total_returns_month")],
        *[F.when(own, F.col(c)).otherwise(F.lit(0).cast("decimal(29,2)")).alias(c)
          for c in ("gross_sales_month", "returns_amount_month", "net_sales_month", "total_cogs_month",
                    "gross_profit_month")],
        F.when(own, F.col("last_purchase_date_month")).alias("last_purchase_date_month"),
    )
    out = _history_columns(filled, churn_days)
    w = Window.partitionBy("customer_id").orderBy("period_month")
    return out.withColumn(
        "is_reactivated_flag",
        F.when((F.col("active_month_flag") == 1) & (F.lag("is_churned_flag").over(w) == 1), 1).otherwise(0))


# ----------------------------------------------------------------------- A01
def avg_exact(c: str, scale: int = 6) -> Column:
    """Average of a decimal column: exact sum / count, rounded half-up."""
    return rnd(F.sum(c).cast("double") / F.count(c), scale)


def cohort_retention(history: DataFrame) -> DataFrame:
    """Cohort × month number → customers, active, retention/churn %, sales, avg LTV.

    On M08 the denominator is the customers present in the cell (D8); on the
    dense M09 it is the cohort size, since every customer has every month.
    """
    h = history.select(
        "customer_id", month_start(F.col("first_purchase_date")).alias("cohort_month"),
        (month_index(F.col("period_month")) - month_index(F.col("cohort_month"))).alias("month_number"),
        "active_month_flag", "net_sales_month", "cumulative_gross_profit_ltv")
    g = h.groupBy("cohort_month", "month_number").agg(
        F.countDistinct("customer_id").alias("total_customers_in_cohort"),
        F.sum("active_month_flag").alias("active_customers"),
        F.sum("net_sales_month").alias("total_cohort_net_sales"),
        avg_exact("cumulative_gross_profit_ltv").alias("average_ltv_gross_profit"),
    )
    pct = safe_div(F.col("active_customers") * 100, F.col("total_customers_in_cohort"))
    return g.select(
        "cohort_month", "month_number", "total_customers_in_cohort", "active_customers",
        rnd(pct, 2).alias("retention_rate_pct"),
        rnd(F.lit(100.0) - pct, 2).alias("churn_rate_pct"),
        "total_cohort_net_sales", "average_ltv_gross_profit",
    ).orderBy("cohort_month", "month_number")


# ----------------------------------------------------------------------- K01
def churn_rate_monthly(enriched: DataFrame, base: DataFrame, as_of, churn_days: int = 90) -> DataFrame:
    """Churned in M ÷ active at the start of M.

    Only invoices are purchases (a return never makes a customer active), and
    only customers of the churn base (K02) count.  Active = last invoice to date
    within ``churn_days`` of the month start; the dense history gives every
    customer one row per month, so a month's counts are plain conditional sums.
    """
    invoices = enriched.where(F.col("sop_type") == 3).join(base.select("customer_id"), "customer_id", "left_semi")
    dense = customer_monthly_dense(invoices, as_of, churn_days)
    w = Window.partitionBy("customer_id").orderBy("period_month")
    active = F.datediff(F.col("period_month"), F.col("cumulative_last_purchase_date")) <= churn_days
    c = dense.select("customer_id", "period_month", active.alias("is_active"))
    c = c.withColumn("was_active", F.coalesce(F.lag("is_active").over(w), F.lit(False)))
    g = c.groupBy("period_month").agg(
        F.count_if(F.col("was_active")).alias("active_start_month"),
        F.count_if(F.col("was_active") & ~F.col("is_active")).alias("churned_customers"),
    )
    return g.select("period_month", "active_start_month", "churned_customers",
                    rnd(safe_div(F.col("churned_customers") * 100, F.col("active_start_month")), 2).alias("churn_rate_pct"))


# ----------------------------------------------------------------------- K02
def churn_base_customers(customers: DataFrame, headers: DataFrame, grace_days: int = 15) -> DataFrame:
    """Customers that count for churn.

    Excluded: accounts marked inactive that made no valid purchase within
    ``grace_days`` of creation (test or mistyped accounts).  Valid purchases are
    non-voided invoices (type 3); quotes, orders, back orders and voided
    documents never count.
    """
    valid = headers.where((F.col("sop_type") == 3) & (F.col("is_voided") == 0))
    first_valid = valid.groupBy("customer_id").agg(F.min("document_date").alias("first_valid_purchase_date"))
    c = customers.select("customer_id", "customer_name", "is_inactive", F.col("created_at").cast("date").alias("created_date"))
    j = c.join(first_valid, "customer_id", "left")
    bought_in_grace = F.col("first_valid_purchase_date") <= F.date_add("created_date", grace_days)
    excluded = (F.col("is_inactive") == 1) & ~F.coalesce(bought_in_grace, F.lit(False))
    return j.where(~excluded).select("customer_id", "customer_name", "created_date", "is_inactive",
                                     "first_valid_purchase_date")


# ------------------------------------------------------------------- K03–K05
def ltv_historical(summary: DataFrame) -> DataFrame:
    """Realised LTV and tenure per customer (projection over M07)."""
    net, cogs = F.col("total_net_revenue"), F.col("total_cogs")
    return summary.select(
        "customer_id", "customer_name", "customer_class_id", "first_purchase_date", "last_purchase_date",
        F.datediff("last_purchase_date", "first_purchase_date").alias("customer_tenure_days"),
        "total_orders_count", "total_gross_revenue", "total_returns_amount", "total_net_revenue", "total_cogs",
        (net - cogs).alias("historical_ltv_gross_profit"),
        rnd(safe_div(net, F.col("total_orders_count")), 2).alias("average_order_value"),
        rnd(safe_div((net - cogs) * 100, net), 2).alias("gross_margin_pct"),
    )


def _segment_base(summary: DataFrame, key: Column) -> DataFrame:
    buyers = summary.where(F.col("total_orders_count") > 0)
    return buyers.groupBy(key).agg(
        F.count(F.lit(1)).alias("customers"),
        F.sum("total_orders_count").alias("orders"),
        F.sum("total_net_revenue").alias("net_revenue"),
        F.sum("historical_ltv_gross_profit").alias("gross_profit"),
        F.count_if(F.col("current_churn_status") == L.CHURN_CHURNED).alias("churned"),
    )


def ltv_predictive(summary: DataFrame) -> DataFrame:
    """Per cohort month, ARPU × gross margin ÷ churn rate (NULL when no churn)."""
    g = _segment_base(summary, month_start(F.col("first_purchase_date")).alias("cohort_month"))
    arpu = safe_div(F.col("net_revenue"), F.col("customers"))
    margin = safe_div(F.col("gross_profit"), F.col("net_revenue"))
    churn = safe_div(F.col("churned"), F.col("customers"))
    return g.select(
        "cohort_month", "customers",
        rnd(arpu, 2).alias("arpu"),
        rnd(margin * 100, 2).alias("gross_margin_pct"),
        rnd(churn * 100, 2).alias("churn_rate_pct"),
        rnd(arpu * margin / F.nullif(churn, F.lit(0.0)), 2).alias("predictive_ltv"),
    )


def ltv_traditional(summary: DataFrame) -> DataFrame:
    """Per customer class, AOV × purchase frequency × lifespan (1 / churn)."""
    g = _segment_base(summary, F.coalesce(F.col("customer_class_id"), F.lit(L.CLASS_UNKNOWN)).alias("customer_class_id"))
    aov = safe_div(F.col("net_revenue"), F.col("orders"))
    pf = safe_div(F.col("orders"), F.col("customers"))
    churn = safe_div(F.col("churned"), F.col("customers"))
    lifespan = F.lit(1.0) / F.nullif(churn, F.lit(0.0))
    return g.select(
        "customer_class_id", "customers",
        rnd(aov, 2).alias("average_order_value"),
        rnd(pf, 4).alias("purchase_frequency"),
        rnd(lifespan, 4).alias("customer_lifespan"),
        rnd(aov * pf * lifespan, 2).alias("traditional_ltv"),
    )


# ----------------------------------------------------------------------- V06
def churn_history(fact: DataFrame, churn_days: int = 90, target_offset_days: int = 28, **filters) -> DataFrame:
    """Per month present, customers active / churned at the month target.

    target(M) = first day of M + 28 days; a customer seen up to the target is
    active when some purchase lies in [target − 90, target], else churned.
    """
    # everything below derives from this one distinct frame: the fact is computed once
    # (a line without a customer belongs to no customer's history)
    s = stage(apply_filters(fact, **filters).where(F.col("customer_id").isNotNull())
              .select("customer_id", "document_date").distinct())
    months = bounded(
        s.select(month_start(F.col("document_date")).alias("m")).distinct()
        .select("m", F.date_add("m", target_offset_days).alias("target")))
    # month starts whose target can fall in [d, d + churn_days]
    cand = s.select(
        "customer_id", "document_date",
        F.explode(F.sequence(month_start(F.date_sub("document_date", target_offset_days)),
                             month_start(F.date_add("document_date", churn_days)),
                             F.expr("interval 1 month"))).alias("m"))
    hits = cand.join(months, "m").where(
        (F.col("target") >= F.col("document_date")) &
        (F.col("target") <= F.date_add("document_date", churn_days)))
    active = hits.groupBy("m").agg(F.countDistinct("customer_id").alias("active_customers"))
    # customers seen up to each target: cumulative count of first purchases
    firsts = s.groupBy("customer_id").agg(F.min("document_date").alias("first_date"))
    # first month whose target is on or after the first purchase
    first_m = F.when(F.dayofmonth(F.date_sub("first_date", target_offset_days)) == 1,
                     F.date_sub("first_date", target_offset_days)) \
               .otherwise(F.add_months(month_start(F.date_sub("first_date", target_offset_days)), 1))
    new_per_m = firsts.groupBy(first_m.alias("m")).agg(F.count(F.lit(1)).alias("new_customers"))
    # calendar-bounded frame (one row per month): an unpartitioned running sum is fine here
    timeline = months.select("m").join(new_per_m, "m", "full").na.fill(0, ["new_customers"])
    wt = Window.orderBy("m").rowsBetween(Window.unboundedPreceding, 0)
    timeline = timeline.select("m", F.sum("new_customers").over(wt).alias("total"))
    out = months.join(timeline, "m").join(active, "m", "left")
    act = F.coalesce(F.col("active_customers"), F.lit(0)).cast("bigint")
    churned = (F.col("total") - act).cast("bigint")
    ym = F.date_format("m", "yyyy-MM")
    return out.select(
        ym.alias("year_month"), ym.alias("period"),
        act.alias("active_customers"), churned.alias("churned_customers"),
        ratio_or(churned * 100, F.col("total"), F.col("total") > 0, 0.0, 2).alias("churn_rate_pct"),
    ).orderBy("year_month")


# ----------------------------------------------------------------------- V07
def cohort_matrix(fact: DataFrame, n_cohorts: int = 6, n_periods: int = 6, **filters) -> DataFrame:
    """Retention of the last ``n_cohorts`` cohorts over the next
    ``n_periods`` months *present in the data* (month index = position among
    the months that have sales, not calendar distance).  Cells with no later
    month stay 0.0; ``m0`` is 100.0 by construction."""
    s = apply_filters(fact, **filters).where(F.col("customer_id").isNotNull())
    cust_month = stage(s.select("customer_id", month_start(F.col("document_date")).alias("m")).distinct())
    # months present → position (bounded by the calendar)
    months = cust_month.select("m").distinct()
    months = bounded(months.select("m", F.dense_rank().over(Window.orderBy("m")).alias("idx")))
    cohort = cust_month.groupBy("customer_id").agg(F.min("m").alias("cohort"))
    recent = bounded(cohort.select("cohort").distinct()
                     .select("cohort", F.dense_rank().over(Window.orderBy(F.desc("cohort"))).alias("rk"))
                     .where(F.col("rk") <= n_cohorts).select("cohort"))
    members = cohort.join(recent, "cohort")
    sizes = members.groupBy("cohort").agg(F.count(F.lit(1)).alias("total_users"))
    act = (cust_month.join(members, "customer_id")
           .join(months, "m")
           .join(months.select(F.col("m").alias("cohort"), F.col("idx").alias("cidx")), "cohort")
           # (cohort, customer, month) is unique, so cells are plain counts
           .select("cohort", "customer_id", (F.col("idx") - F.col("cidx")).alias("period"))
           .where((F.col("period") >= 0) & (F.col("period") < n_periods)))
    cells = act.groupBy("cohort").pivot("period", list(range(n_periods))).agg(F.count("customer_id"))
    j = sizes.join(cells, "cohort", "left")
    cols = []
    for p in range(n_periods):
        a = F.coalesce(F.col(str(p)), F.lit(0))
        cols.append(ratio_or(a * 100, F.col("total_users"), F.col("total_users") > 0, 0.0, 1).alias(f"m{p}"))
    return j.select(F.date_format("cohort", "yyyy-MM").alias("cohort_month"), "total_users",
                    F.col("total_users").alias("new_customers"), *cols).orderBy("cohort_month")


def cohort_matrix_periods(fact: DataFrame, n_cohorts: int = 6, n_periods: int = 6, **filters) -> DataFrame:
    """V07 nested form: ``periods`` = one struct (period, active_users,
    retention_pct) for each month that exists in the data from the cohort's
    month on, at most ``n_periods``."""
    s = apply_filters(fact, **filters).where(F.col("customer_id").isNotNull())
    cust_month = stage(s.select("customer_id", month_start(F.col("document_date")).alias("m")).distinct())
    # calendar-bounded: one row per month present
    months = cust_month.select("m").distinct().select("m", F.dense_rank().over(Window.orderBy("m")).alias("idx"))
    cohort = cust_month.groupBy("customer_id").agg(F.min("m").alias("cohort"))
    sizes = cohort.groupBy("cohort").agg(F.count(F.lit(1)).alias("total_users"))
    recent = (sizes.select("*", F.row_number().over(Window.orderBy(F.desc("cohort"))).alias("rk"))
              .where(F.col("rk") <= n_cohorts).drop("rk"))
    active = (cust_month.join(cohort, "customer_id").groupBy("cohort", "m")
              .agg(F.count(F.lit(1)).alias("active_users")))
    # cohort months x following months: both sides at most n_cohorts and one row per month
    start = months.select(F.col("m").alias("cohort"), F.col("idx").alias("cidx"))
    offsets = F.explode(F.sequence(F.lit(0), F.lit(n_periods - 1))).alias("period")
    cells = (recent.join(bounded(start), "cohort").select("cohort", "total_users", "cidx", offsets)
             .join(bounded(months), F.col("idx") == F.col("cidx") + F.col("period"))
             .join(active, ["cohort", "m"], "left"))
    users = F.coalesce("active_users", F.lit(0).cast("bigint"))
    cell = F.struct(F.col("period").alias("n"), F.concat(F.lit("M+"), F.col("period").cast("string")).alias("period"),
                    users.alias("active_users"),
                    ratio_or(users * 100, F.col("total_users"), F.col("total_users") > 0, 0.0, 1).alias("retention_pct"))
    out = cells.groupBy("cohort", "total_users").agg(F.sort_array(F.collect_list(cell)).alias("cells"))
    return out.select(F.date_format("cohort", "yyyy-MM").alias("cohort_month"), "total_users",
                      F.transform("cells", lambda c: c.dropFields("n")).alias("periods"))
