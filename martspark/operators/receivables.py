"""Accounts receivable (V19–V25, K07/K08): open documents valued in USD at the
latest rate (D17, D28), days past due, aging buckets, KPIs and breakdowns.

Credits (types 7, 8, 9) are negative.  KPIs sum only positive overdue and
current balances; breakdowns include credits.  DSO uses the unfiltered 90-day
net sales.  All aggregates are algebraic; no group is collected.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import labels as L
from ..functions.clean import code_label
from ..functions.numeric import ratio_or, rnd
from ..plans.broadcast import small
from .facts import aging_bucket
from .org import person_name, territory_role
from .sales import _date, dated_from, money_sum

ALL = "ALL"


def ar_documents(rm20101: DataFrame, rm00101: DataFrame, rm00301: DataFrame, rm00303: DataFrame,
                 latest_rate: Column, as_of) -> DataFrame:
    """V19 + V20: open, non-voided documents with names, USD amounts and aging."""
    ar = rm20101.where((F.col("CURTRXAM") > 0) & (F.col("VOIDSTTS") == 0))
    c = small(rm00101.select(F.trim("CUSTNMBR").alias("c_key"), F.rtrim("CUSTNAME").alias("customer_name"),
                             F.rtrim("CUSTCLAS").alias("c_class"), F.col("CRLMTAMT").alias("c_limit")))
    sp = small(rm00301.select(F.trim("SLPRSNID").alias("sp_key"),
                              person_name(F.col("SLPRSNFN"), F.col("SPRSNSLN")).alias("sp_name"),
                              F.trim("SALSTERR").alias("sp_terr_key")))
    t = territory_role(rm00303, "t")
    t_sp = territory_role(rm00303, "tsp")
    j = (ar.join(c, F.trim(ar["CUSTNMBR"]) == c["c_key"], "left")
         .join(sp, F.trim(ar["SLPRSNID"]) == sp["sp_key"], "left")
         .join(t, F.trim(ar["SLSTERCD"]) == t["t_key"], "left")
         .join(t_sp, F.col("sp_terr_key") == t_sp["tsp_key"], "left"))
    base = j.select(
        F.rtrim("CUSTNMBR").alias("customer_id"), "customer_name",
        F.coalesce(F.nullif(F.col("c_class"), F.lit("")), F.lit(L.SERVICE_GENERAL)).alias("customer_class_id"),
        F.rtrim("DOCNUMBR").alias("doc_number"), F.col("RMDTYPAL").alias("doc_type"),
        code_label(F.col("RMDTYPAL"), L.AR_SERVICE_TYPE_LABELS, L.AR_TYPE_DEFAULT).alias("doc_type_desc"),
        F.col("DOCDATE").cast("date").alias("doc_date"), F.col("DUEDATE").cast("date").alias("due_date"),
        F.col("ORTRXAMT").cast("double").alias("orig_amount_vef"),
        F.col("CURTRXAM").cast("double").alias("current_balance_vef"),
        F.rtrim("CURNCYID").alias("currency_id"),
        F.coalesce(F.nullif(F.col("sp_name"), F.lit("")), F.rtrim("SLPRSNID"), F.lit(L.SERVICE_UNASSIGNED))
         .alias("salesperson_name"),
        F.coalesce(F.nullif(F.col("t_desc"), F.lit("")), F.nullif(F.col("tsp_desc"), F.lit("")),
                   F.lit(L.SERVICE_NO_ZONE)).alias("territory_name"),
        F.coalesce(F.col("c_limit"), F.lit(0).cast("decimal(19,2)")).cast("double").alias("credit_limit_vef"),
    )
    sign = F.when(F.col("doc_type").isin(*L.AR_CREDIT_TYPES), F.lit(-1.0)).otherwise(F.lit(1.0))
    days = F.coalesce(F.datediff(_date(as_of), F.col("due_date")), F.lit(0))
    fxr = F.col("_fx")
    return base.withColumn("_fx", latest_rate).select(
        *base.columns,
        rnd(F.col("current_balance_vef") / fxr * sign, 2).alias("balance_usd"),
        rnd(F.col("orig_amount_vef") / fxr * sign, 2).alias("orig_amount_usd"),
        rnd(F.col("credit_limit_vef") / fxr, 2).alias("credit_limit_usd"),
        days.alias("overdue_days"),
        aging_bucket(days).alias("aging_bucket"),
        F.when(days > 0, 1).otherwise(0).alias("is_overdue"),
    )


def apply_ar_filters(df: DataFrame, territory=ALL, customer_class=ALL, salesperson=ALL) -> DataFrame:
    if territory and territory != ALL:
        df = df.where(F.col("territory_name") == territory)
    if customer_class and customer_class != ALL:
        df = df.where(F.col("customer_class_id") == customer_class)
    if salesperson and salesperson != ALL:
        df = df.where(F.col("salesperson_name") == salesperson)
    return df


def sales_90d_usd(sop30200: DataFrame, sop30300: DataFrame, latest_rate: Column, as_of, days: int = 90) -> Column:
    """Scalar: signed net sales of the last ``days`` days in USD (unfiltered, D17)."""
    start = F.date_sub(_date(as_of), days)
    h = sop30200.where(F.col("SOPTYPE").isin(3, 4) & (F.col("VOIDSTTS") == 0) & (F.col("DOCDATE") >= start)) \
        .select(F.col("SOPTYPE").alias("h_type"), F.trim("SOPNUMBE").alias("h_key"))
    line = sop30300.where(dated_from(start)).select(
        F.col("SOPTYPE").alias("l_type"), F.trim("SOPNUMBE").alias("l_key"), "XTNDPRCE", "MRKDNAMT")
    j = line.join(h, (line["l_type"] == h["h_type"]) & (line["l_key"] == h["h_key"]))
    sign = F.when(F.col("h_type") == 4, F.lit(-1.0).cast("decimal(2,1)")).otherwise(F.lit(1.0).cast("decimal(2,1)"))
    net = F.sum(sign * (F.col("XTNDPRCE") - F.coalesce(F.col("MRKDNAMT"), F.lit(0).cast("decimal(19,2)"))))
    return j.select((net.cast("double") / latest_rate).alias("s")).scalar()


def ar_kpis(docs: DataFrame, sales90: Column, latest_rate: Column, **filters) -> DataFrame:
    """Balance, overdue, current, delinquency %, DSO, debtors, documents."""
    d = apply_ar_filters(docs, **filters)
    bal, od = F.col("balance_usd"), F.col("overdue_days")
    money = bal.cast("decimal(30,2)")
    # document level first: documents become a plain count, one distinct count stays
    doc = d.groupBy("doc_number").agg(
        F.sum(money).alias("bal"), F.sum(F.when((od > 0) & (bal > 0), money)).alias("overdue"),
        F.sum(F.when((od <= 0) & (bal > 0), money)).alias("current"),
        F.max(F.when(bal > 0, F.col("customer_id"))).alias("debtor"))  # a document has one customer
    zero = F.lit(0).cast("decimal(30,2)")
    g = doc.agg(
        F.sum("bal").cast("double").alias("total_ar_balance_usd"),
        F.coalesce(F.sum("overdue"), zero).cast("double").alias("total_overdue_usd"),
        F.coalesce(F.sum("current"), zero).cast("double").alias("total_current_usd"),
        F.countDistinct("debtor").alias("customers_with_debt_count"),
        F.count("doc_number").alias("open_documents_count"),
    )
    total = F.coalesce(F.col("total_ar_balance_usd"), F.lit(0.0))
    s90 = sales90
    return g.select(
        total.alias("total_ar_balance_usd"), "total_overdue_usd", "total_current_usd",
        ratio_or(F.col("total_overdue_usd") * 100, total, total > 0, 0.0, 2).alias("delinquency_rate_pct"),
        F.when(s90 > 0, rnd(total / s90 * 90, 1)).otherwise(F.lit(0.0)).alias("dso_days"),
        "customers_with_debt_count", "open_documents_count",
        s90.alias("sales_90d_usd"), latest_rate.alias("exchange_rate_applied"),
    )


def ar_aging_summary(docs: DataFrame, **filters) -> DataFrame:
    """Documents and balance per bucket, in bucket order."""
    d = apply_ar_filters(docs, **filters)
    g = d.groupBy("aging_bucket").agg(
        F.count("doc_number").alias("docs_count"),
        F.round(money_sum("balance_usd"), 2).cast("double").alias("total_balance_usd"))
    idx = F.lit(99)
    for i, b in reversed(list(enumerate(L.AGING_BUCKETS))):
        idx = F.when(F.col("aging_bucket") == b, F.lit(i)).otherwise(idx)
    return g.orderBy(idx).select("aging_bucket", "docs_count", "total_balance_usd")


def _ar_breakdown(docs: DataFrame, key: str) -> DataFrame:
    od = F.col("overdue_days") > 0
    g = docs.groupBy(key).agg(
        F.round(money_sum("balance_usd"), 2).cast("double").alias("total_ar_usd"),
        F.round(F.coalesce(F.sum(F.when(od, F.col("balance_usd").cast("decimal(30,2)"))),
                           F.lit(0).cast("decimal(30,2)")), 2).cast("double").alias("overdue_usd"),
        F.countDistinct("customer_id").alias("customers_count"),
        F.count("doc_number").alias("docs_count"),
    )
    tot = F.col("total_ar_usd")
    return g.withColumn("delinquency_pct", ratio_or(F.col("overdue_usd") * 100, tot, tot > 0, 0.0, 1))


def ar_by_territory(docs: DataFrame) -> DataFrame:
    """Receivables per territory, largest first."""
    return _ar_breakdown(docs, "territory_name").orderBy(F.desc("total_ar_usd"), "territory_name")


def ar_by_salesperson(docs: DataFrame) -> DataFrame:
    """Receivables per salesperson (unassigned excluded), largest first."""
    return (_ar_breakdown(docs, "salesperson_name").where(F.col("salesperson_name") != L.SERVICE_UNASSIGNED)
            .orderBy(F.desc("total_ar_usd"), "salesperson_name"))


AR_KEYS = ("customer_id", "customer_name", "customer_class_id", "territory_name", "salesperson_name")


def ar_customer_directory(docs: DataFrame, aging_filter: str = ALL, high_risk_days: int = 60,
                          **filters) -> DataFrame:
    """V24 (+K08): debt split, credit utilisation, max days and risk per customer row.

    Grouped by customer plus document-level territory and salesperson, so a
    customer can appear once per (territory, salesperson) pair (D23); rows with
    a NULL group key are dropped (D5).  ``aging_filter``: ALL, OVERDUE, CURRENT.
    """
    d = apply_ar_filters(docs, **filters).dropna(subset=list(AR_KEYS))
    od = F.col("overdue_days") > 0
    dec = F.col("balance_usd").cast("decimal(30,2)")
    zero = F.lit(0).cast("decimal(30,2)")
    g = d.groupBy(*AR_KEYS).agg(
        F.round(F.sum(dec), 2).cast("double").alias("total_debt_usd"),
        F.round(F.coalesce(F.sum(F.when(od, dec)), zero), 2).cast("double").alias("overdue_debt_usd"),
        F.round(F.coalesce(F.sum(F.when(~od, dec)), zero), 2).cast("double").alias("current_debt_usd"),
        F.max("credit_limit_usd").alias("credit_limit_usd"),
        F.count("doc_number").alias("docs_count"),
        F.max("overdue_days").alias("max_overdue_days"),
    )
    lim = F.col("credit_limit_usd")
    mx = F.col("max_overdue_days")
    g = g.select("*",
                 ratio_or(F.col("total_debt_usd") * 100, lim, lim > 0, 0.0, 1).alias("credit_utilization_pct"),
                 F.when(mx > high_risk_days, L.RISK_HIGH).when(mx > 0, L.RISK_MODERATE).otherwise(L.RISK_OK)
                  .alias("risk_status"))
    if aging_filter == "OVERDUE":
        g = g.where(F.col("overdue_debt_usd") > 0)
    elif aging_filter == "CURRENT":
        g = g.where(F.col("overdue_debt_usd") <= 0)
    return g.orderBy(F.desc("total_debt_usd"), *AR_KEYS)


def ar_customer_documents(docs: DataFrame, customer_id: str | None = None) -> DataFrame:
    """Open documents of one customer by due date (all customers when None).

    The bulk form is a global sort (range-partitioned), so a customer with many
    documents is split across tasks rather than sorted in one.
    """
    d = docs if customer_id is None else docs.where(F.col("customer_id") == customer_id)
    return d.orderBy("customer_id", F.col("due_date").asc_nulls_last(), "doc_number", "doc_type")
