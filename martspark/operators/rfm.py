"""RFM segmentation: quintile form of the analysis layer (A02) and median form
of the service layer (V08–V11, V29), customer 360 (V12).

Global quintiles and medians use ``plans.quantiles`` (exact cuts by refinement
over the staged metrics) instead of unpartitioned windows, global sorts or a
single-task percentile buffer.  Ties are broken by ``customer_id`` (D6) so results are deterministic.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import labels as L
from ..functions.numeric import ratio_or, rnd, safe_div
from ..plans.quantiles import Spec, medians, ntiles
from ..plans.topk import top_k_per_group
from ..plans.stage import stage
from .sales import _date, apply_filters, money_sum

SERVICE_KEYS = ("customer_id", "customer_name", "customer_class_id", "territory_name", "salesperson_name")


# ----------------------------------------------------------------------- A02
def rfm_quintiles(summary: DataFrame) -> DataFrame:
    """R/F/M quintile scores and the ordered six-segment rule, per customer."""
    base = summary.where(F.col("total_orders_count") > 0).select(
        "customer_id", "customer_name", "customer_class_id", "territory_id",
        F.col("days_since_last_purchase").alias("recency_days"),
        F.col("total_orders_count").alias("frequency_orders"),
        F.col("total_net_revenue").alias("monetary_net_revenue"),
        "historical_ltv_gross_profit", "average_order_value", "current_churn_status")
    base = stage(base, "rfm-base")  # one computation of the customer summary for all three scores
    # the cuts of the three scores come out of the same passes; scoring compares each row with them
    s = ntiles(base, "customer_id", {"r_score": Spec("recency_days", descending=True), "f_score": Spec("frequency_orders"),
                                     "m_score": Spec("monetary_net_revenue")}, 5)
    r, f, m = F.col("r_score"), F.col("f_score"), F.col("m_score")
    seg = (F.when((r >= 4) & (f >= 4) & (m >= 4), L.RFM_CHAMPIONS)
           .when((r >= 3) & (f >= 3), L.RFM_LOYAL)
           .when((r >= 4) & (f <= 2), L.RFM_PROMISING)
           .when((r <= 2) & (f >= 4), L.RFM_AT_RISK)
           .when((r == 1) & (f == 1), L.RFM_HIBERNATING)
           .otherwise(L.RFM_STANDARD))
    return s.withColumn("customer_rfm_segment", seg)


def rfm_segment_summary(quintiles: DataFrame) -> DataFrame:
    """A02 summary: per segment and churn status, largest revenue first."""
    g = quintiles.groupBy("customer_rfm_segment", "current_churn_status").agg(
        F.countDistinct("customer_id").alias("total_customers"),
        rnd(F.sum("recency_days").cast("double") / F.count("recency_days"), 1).alias("avg_recency_days"),
        rnd(F.sum("frequency_orders").cast("double") / F.count("frequency_orders"), 1).alias("avg_orders_count"),
        F.round(F.sum("monetary_net_revenue"), 2).cast("double").alias("total_revenue_contribution"),
        rnd(F.sum("historical_ltv_gross_profit").cast("double") / F.count("historical_ltv_gross_profit"), 2)
         .alias("avg_historical_ltv"),
    )
    return g.orderBy(F.desc("total_revenue_contribution"), "customer_rfm_segment", "current_churn_status")


# ----------------------------------------------------------------------- V08
def customer_rfm_metrics(fact: DataFrame, as_of, **filters) -> DataFrame:
    """Per (customer, name, class, territory, salesperson) — one customer may
    give several rows when its documents carry different territories (D23);
    rows with a NULL group key are dropped like the pandas group-by (D5)."""
    s = apply_filters(fact, **filters).dropna(subset=list(SERVICE_KEYS))
    # document level first: the shuffle is spread by document, distinct documents become a plain count
    docs = s.groupBy(*SERVICE_KEYS, "invoice_number").agg(
        F.max("document_date").alias("doc_last"), F.min("document_date").alias("doc_first"),
        money_sum("net_sales_amount").alias("doc_net"), money_sum("gross_profit_amount").alias("doc_gp"))
    g = docs.groupBy(*SERVICE_KEYS).agg(
        F.max("doc_last").alias("last_purchase"),
        F.min("doc_first").alias("first_purchase"),
        F.count("invoice_number").alias("frequency"),
        F.sum("doc_net").cast("double").alias("monetary"),
        F.sum("doc_gp").cast("double").alias("gross_profit_ltv"),
    )
    today = _date(as_of)
    return g.select(
        *SERVICE_KEYS, "last_purchase", "first_purchase", "frequency", "monetary", "gross_profit_ltv",
        F.datediff(today, "last_purchase").alias("recency_days"),
        F.datediff(today, "first_purchase").alias("tenure_days"),
        rnd(safe_div(F.col("monetary"), F.col("frequency")), 2).alias("average_order_value"),
        F.col("frequency").alias("total_orders"),
        F.col("monetary").alias("total_net_sales"),
        F.col("gross_profit_ltv").alias("customer_ltv_gross_profit"),
    )


# ----------------------------------------------------------------------- V09
def _row_keyed(metrics: DataFrame) -> DataFrame:
    return metrics.select("recency_days", "frequency", "monetary",
                          F.xxhash64(*SERVICE_KEYS).alias("_row_key"))


def rfm_medians(metrics: DataFrame) -> DataFrame:
    """One row with the exact interpolated medians of recency, frequency, monetary."""
    names = ("recency_days", "frequency", "monetary")
    found = medians(stage(_row_keyed(metrics), "rfm-medians"), "_row_key", names)
    return metrics.sparkSession.range(1).select(*[F.lit(v).cast("double").alias(f"{n}_median")
                                                  for n, v in zip(names, found, strict=True)])


def rfm_median_segments(metrics: DataFrame, vip_days: int = 60, loyal_days: int = 90,
                        promising_days: int = 45) -> DataFrame:
    """The six ordered service segment rules against the medians."""
    # the per-customer metrics are materialised once in the shared checkpoint
    # folder: the medians and the segment rules read them without recomputing
    # the sales fact
    metrics = stage(metrics, "rfm-metrics")
    fm, mm = (F.lit(v).cast("double") for v in medians(_row_keyed(metrics), "_row_key", ("frequency", "monetary")))
    rec, fr, mo = F.col("recency_days"), F.col("frequency"), F.col("monetary")
    seg = (F.when((rec <= vip_days) & (fr >= fm) & (mo >= mm), L.SEG_VIP)
           .when((rec <= loyal_days) & (fr >= fm), L.SEG_LOYAL)
           .when((rec <= promising_days) & (fr < fm), L.SEG_PROMISING)
           .when((rec > loyal_days) & (mo >= mm), L.SEG_AT_RISK)
           .when(rec > loyal_days, L.SEG_LOST)
           .otherwise(L.SEG_STANDARD))
    return metrics.withColumn("segment", seg).withColumn("rfm_segment", F.col("segment"))


def rfm_median_summary(segments: DataFrame) -> DataFrame:
    """Rows, revenue, average LTV and recency per segment."""
    g = segments.groupBy("segment").agg(
        F.count("customer_id").alias("customer_count"),
        F.round(money_sum("monetary"), 2).cast("double").alias("total_revenue"),
        rnd(money_sum("gross_profit_ltv").cast("double") / F.count("gross_profit_ltv"), 2).alias("avg_ltv"),
        rnd(F.sum("recency_days").cast("double") / F.count("recency_days"), 1).alias("avg_recency"),
    )
    return g.select("segment", "customer_count", "total_revenue", "avg_ltv", "avg_recency",
                    F.col("total_revenue").alias("total_sales"), F.col("avg_recency").alias("avg_recency_days"))


# Recommended action per service segment (dashboard table).
SEGMENT_ACTIONS = {
    L.SEG_AT_RISK: "Campaña de reactivación / Visita comercial",
    L.SEG_VIP: "Trato preferencial y acuerdos de volumen",
    L.SEG_LOST: "Ofertas especiales de reenganche",
}
DEFAULT_ACTION = "Mantener fidelización"


def segment_actions(summary: DataFrame) -> DataFrame:
    """Recommended action per segment."""
    expr = F.lit(DEFAULT_ACTION)
    for seg, action in SEGMENT_ACTIONS.items():
        expr = F.when(F.col("segment") == seg, F.lit(action)).otherwise(expr)
    return summary.withColumn("recommended_action", expr)


# ----------------------------------------------------------------------- V11
def top_ltv_customers(metrics: DataFrame, k: int = 20) -> DataFrame:
    """Top-k rows by gross-profit LTV (ties by the group keys)."""
    return metrics.orderBy(F.desc("gross_profit_ltv"), *SERVICE_KEYS).limit(k)


# ----------------------------------------------------------------------- V12
def customer_360_metrics(fact: DataFrame, customers: DataFrame) -> DataFrame:
    """V12 (bulk form): profile + totals for every customer of the directory."""
    t = fact.groupBy("customer_id").agg(
        money_sum("net_sales_amount").cast("double").alias("total_sales"),
        money_sum("gross_profit_amount").cast("double").alias("total_gross_profit"),
        F.countDistinct("invoice_number").alias("total_orders"),
    )
    j = customers.join(t, "customer_id", "left")
    orders = F.coalesce(F.col("total_orders"), F.lit(0))
    sales = F.coalesce(F.col("total_sales"), F.lit(0.0))
    return j.select(
        *customers.columns,
        sales.alias("total_sales"),
        F.coalesce(F.col("total_gross_profit"), F.lit(0.0)).alias("total_gross_profit"),
        orders.alias("total_orders"),
        ratio_or(sales, orders, orders > 0, 0.0, 2).alias("average_order_value"),
    )


def customer_recent_transactions(fact: DataFrame, k: int = 15) -> DataFrame:
    """The ``k`` most recent lines of every customer (date desc, then document, line)."""
    order = [F.col(c).desc() for c in ("document_date", "invoice_number", "line_item_sequence", "item_number",
                                        "sop_type", "quantity", "net_sales_amount", "gross_profit_amount",
                                        "item_description")]
    top = top_k_per_group(fact, ["customer_id"], order, k,
                          salt_cols=["invoice_number", "line_item_sequence"], rank_col="recency_rank")
    return top.select(
        "customer_id", "recency_rank", F.date_format("document_date", "yyyy-MM-dd").alias("document_date"),
        F.col("sop_type").alias("document_type_id"), "invoice_number", "line_item_sequence",
        F.col("item_number").alias("item_id"), "item_description", "quantity", "net_sales_amount",
        "gross_profit_amount", "doc_type_desc")
