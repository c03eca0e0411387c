"""Fact tables: sales line fact (M16), customer-month snapshot (M17),
open receivables (M18), inventory balance (M19), inventory transactions (M20).

Dimension lookups are left joins on the natural key with unknown-member keys
(``md5('UNKNOWN_…')``) for misses, so no fact row is lost.  Dimensions are
joined through ``plans.broadcast.small``: broadcast when the planner's size
estimate is small, otherwise a shuffle join that AQE can still convert or
split at run time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import labels as L
from ..functions.numeric import rnd
from ..plans.broadcast import small
from . import fx
from .dims import unknown_key
from .sales import date_sk


def _current_customers(dim_customer: DataFrame) -> DataFrame:
    return small(dim_customer.where(F.col("is_current")).select(
        F.col("customer_id").alias("dc_customer_id"), "customer_sk",
        F.col("salesperson_id").alias("dc_salesperson_id"), F.col("territory_id").alias("dc_territory_id")))


DOCUMENT_KEYS = ("customer_sk", "salesperson_sk", "territory_sk")


def document_keys(headers: DataFrame, dim_customer: DataFrame, dim_salesperson: DataFrame,
                  dim_territory: DataFrame) -> DataFrame:
    """Headers with the surrogate keys that all lines of a document share (NULL without a dimension row)."""
    c = _current_customers(dim_customer).drop("dc_salesperson_id", "dc_territory_id")
    sp = small(dim_salesperson.select(F.col("salesperson_id").alias("ds_sp"), "salesperson_sk"))
    t = small(dim_territory.select(F.col("territory_id").alias("dt_terr"), "territory_sk"))
    j = (headers
         .join(c, headers["customer_id"] == c["dc_customer_id"], "left")
         .join(sp, headers["salesperson_id"] == sp["ds_sp"], "left")
         .join(t, headers["territory_id"] == t["dt_terr"], "left"))
    return j.select(*[headers[x] for x in headers.columns], *DOCUMENT_KEYS)


def product_key(lines: DataFrame, dim_product: DataFrame) -> DataFrame:
    """Lines with their product's surrogate key (NULL without a dimension row)."""
    p = small(dim_product.select(F.col("item_number").alias("dp_item"), "product_sk"))
    return lines.join(p, lines["item_number"] == p["dp_item"], "left").drop("dp_item")


def fact_sales(enriched: DataFrame, dim_customer: DataFrame, dim_product: DataFrame,
               dim_salesperson: DataFrame, dim_territory: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """One row per sales document line with surrogate keys; ``carry`` names line columns to pass through.
    Lines that have their keys already (``document_keys``, ``product_key``) are not joined to the dimensions again."""
    have, j = set(enriched.columns), enriched
    if not have.issuperset(DOCUMENT_KEYS):
        j = document_keys(j, dim_customer, dim_salesperson, dim_territory)
    if "product_sk" not in have:
        j = product_key(j, dim_product)
    return j.select(
        F.md5(F.concat("invoice_number", F.lit("_"), F.col("line_item_sequence").cast("string"), F.lit("_"),
                       F.col("component_sequence").cast("string"))).alias("sales_fact_sk"),
        "invoice_number", "line_item_sequence", "component_sequence", "sop_type",
        F.col("document_type_name").alias("doc_type_desc"), "doc_id", "currency_id", "uofm", "location_code",
        "document_date_sk", "gl_post_date_sk",
        F.coalesce("customer_sk", unknown_key(L.UNKNOWN_CUSTOMER)).alias("customer_sk"),
        F.coalesce("product_sk", unknown_key(L.UNKNOWN_PRODUCT)).alias("product_sk"),
        F.coalesce("salesperson_sk", unknown_key(L.UNKNOWN_SP)).alias("salesperson_sk"),
        F.coalesce("territory_sk", unknown_key(L.UNKNOWN_TERR)).alias("territory_sk"),
        F.col("net_quantity").alias("quantity"), "unit_price",
        F.col("gross_sales_amount").alias("extended_price"), "unit_cost",
        F.col("total_cost_amount").alias("extended_cost"),
        F.coalesce("markdown_amount", F.lit(0).cast("decimal(19,2)")).alias("markdown_amount"),
        "net_sales_amount", "gross_profit_amount", "gross_profit_margin_pct",
        F.lit(0).alias("is_voided"), *carry,
    )


def fact_customer_monthly_snapshot(history: DataFrame, dim_customer: DataFrame, dim_salesperson: DataFrame,
                                   dim_territory: DataFrame) -> DataFrame:
    """Customer × month snapshot; org keys from the customer's current row.

    With the sparse history (M08) the reactivation flag is constant 0 (D7); with
    the dense history (M09) it is meaningful.
    """
    c = _current_customers(dim_customer)
    sp = small(dim_salesperson.select(F.col("salesperson_id").alias("ds_sp"), "salesperson_sk"))
    t = small(dim_territory.select(F.col("territory_id").alias("dt_terr"), "territory_sk"))
    w = Window.partitionBy("customer_id").orderBy("period_month")
    h = history.withColumn("_prev_churned", F.lag("is_churned_flag").over(w))
    j = (h.join(c, h["customer_id"] == c["dc_customer_id"], "left")
         .join(sp, F.col("dc_salesperson_id") == sp["ds_sp"], "left")
         .join(t, F.col("dc_territory_id") == t["dt_terr"], "left"))
    return j.select(
        F.md5(F.concat("customer_id", F.lit("_"), F.col("year_month_sk").cast("string"))).alias("snapshot_sk"),
        "year_month_sk",
        F.coalesce("customer_sk", unknown_key(L.UNKNOWN_CUSTOMER)).alias("customer_sk"),
        F.coalesce("salesperson_sk", unknown_key(L.UNKNOWN_SP)).alias("salesperson_sk"),
        F.coalesce("territory_sk", unknown_key(L.UNKNOWN_TERR)).alias("territory_sk"),
        "customer_id", "active_month_flag", "is_churned_flag", "is_new_customer_flag",
        F.when((F.col("active_month_flag") == 1) & (F.col("_prev_churned") == 1), 1).otherwise(0)
         .alias("is_reactivated_flag"),
        "total_invoices_month", "total_returns_month", "gross_sales_month", "returns_amount_month",
        "net_sales_month", "total_cogs_month", "gross_profit_month", "cumulative_net_sales_ltv",
        "cumulative_gross_profit_ltv",
        F.col("days_since_last_purchase_at_month_end").alias("days_since_last_purchase"),
        F.col("cumulative_last_purchase_date").alias("last_purchase_date"),
    )


def aging_bucket(days) -> F.Column:
    """Five aging buckets on days past due."""
    b = L.AGING_BUCKETS
    return (F.when(days <= 0, b[0]).when(days <= 30, b[1]).when(days <= 60, b[2])
            .when(days <= 90, b[3]).otherwise(b[4]))


def fact_receivables_open(stg_open_ar: DataFrame, dim_customer: DataFrame, dim_salesperson: DataFrame,
                          dim_territory: DataFrame, latest_rate, as_of) -> DataFrame:
    """Open documents in USD at the latest rate, days past due, bucket, keys."""
    c = _current_customers(dim_customer)
    sp = small(dim_salesperson.select(F.col("salesperson_id").alias("ds_sp"), "salesperson_sk"))
    t = small(dim_territory.select(F.col("territory_id").alias("dt_terr"), "territory_sk"))
    a = stg_open_ar.withColumn("_fx", latest_rate)  # scalar subquery evaluated once
    latest_rate = F.col("_fx")
    j = (a.join(c, a["customer_id"] == c["dc_customer_id"], "left")
         .join(sp, a["salesperson_id"] == sp["ds_sp"], "left")
         .join(t, a["territory_id"] == t["dt_terr"], "left"))
    sign = F.when(F.col("doc_type").isin(*L.AR_CREDIT_TYPES), F.lit(-1.0)).otherwise(F.lit(1.0))
    days = F.coalesce(F.datediff(F.lit(as_of), F.col("due_date")), F.lit(0))
    return j.select(
        F.md5(F.concat_ws("|", "doc_number", F.col("doc_type").cast("string"))).alias("ar_document_sk"),
        date_sk(F.col("doc_date")).alias("doc_date_sk"), date_sk(F.col("due_date")).alias("due_date_sk"),
        F.coalesce("customer_sk", unknown_key(L.UNKNOWN_CUSTOMER)).alias("customer_sk"),
        F.coalesce("salesperson_sk", unknown_key(L.UNKNOWN_SP)).alias("salesperson_sk"),
        F.coalesce("territory_sk", unknown_key(L.UNKNOWN_TERR)).alias("territory_sk"),
        "doc_number", "doc_type",
        rnd(F.col("orig_amount_vef").cast("double") / latest_rate * sign, 2).alias("orig_amount_usd"),
        rnd(F.col("current_balance_vef").cast("double") / latest_rate * sign, 2).alias("current_balance_usd"),
        days.alias("overdue_days"),
        aging_bucket(days).alias("aging_bucket"),
        F.when(days > 0, 1).otherwise(0).alias("is_overdue"),
    )


def fact_inventory_balance(stg_item_quantities: DataFrame, valuation: DataFrame, unit_rate, as_of) -> DataFrame:
    """Stock per item × warehouse (record type 2) with item-level cost and
    health measures of M10; valuation per row at the item's USD unit cost."""
    q = stg_item_quantities.where(F.col("record_type") == 2)
    v = valuation.select(F.col("item_number").alias("v_item"), "unit_cost_usd", "unit_cost_vef_used",
                         "annual_cogs_usd", "inventory_turnover", "days_inventory_outstanding",
                         "stock_health_status")
    j = q.join(v, q["item_number"] == v["v_item"], "left").withColumn("_fx", unit_rate)
    unit_rate = F.col("_fx")
    d_sk = date_sk(F.lit(as_of))
    return j.select(
        F.md5(F.concat_ws("|", "item_number", "location_code", d_sk.cast("string"))).alias("balance_sk"),
        d_sk.alias("date_sk"), F.md5("item_number").alias("product_sk"), F.md5("location_code").alias("location_sk"),
        "item_number", "location_code", "qty_on_hand", "qty_allocated", "qty_available", "qty_on_order",
        "safety_stock_qty", "unit_cost_usd",
        rnd(F.col("qty_on_hand").cast("double") * (F.col("unit_cost_vef_used") / unit_rate), 2).alias("total_valuation_usd"),
        F.col("annual_cogs_usd").alias("annualized_cogs_usd"), "inventory_turnover", "days_inventory_outstanding",
        "stock_health_status",
    )


def dim_location(iv40700: DataFrame) -> DataFrame:
    """Warehouse dimension (service naming defaults) with the members of
    stock without a warehouse (all stock) and of movements without one."""
    code = F.coalesce(F.nullif(F.rtrim("LOCNCODE"), F.lit("")), F.lit(L.TOTAL_LOCATION))
    named = iv40700.select(
        F.md5(code).alias("location_sk"), code.alias("location_code"),
        F.coalesce(F.nullif(F.rtrim("LOCNDSCR"), F.lit("")), F.lit(L.SERVICE_DEFAULT_LOCATION_NAME)).alias("location_name"),
    )
    default = F.lit(L.SERVICE_DEFAULT_LOCATION_NAME)
    members = iv40700.sparkSession.range(1).select(F.explode(F.array(
        F.lit(L.TOTAL_LOCATION), F.lit(L.DEFAULT_LOCATION))).alias("location_code"))
    members = members.select(F.md5("location_code").alias("location_sk"), "location_code", default.alias("location_name"))
    return named.unionByName(members).groupBy("location_sk", "location_code").agg(
        F.min("location_name").alias("location_name"))


def fact_inventory_transactions(stg_trx: DataFrame, rates: DataFrame) -> DataFrame:
    """Inventory movements in USD at the as-of rate of the movement date."""
    base = stg_trx.select("doc_type", "doc_type_desc", "doc_number", "doc_date", "item_number",
                          "from_location_code", "to_location_code", "trx_qty", "unit_cost_vef", "extended_cost_vef")
    j = fx.asof_join(base, rates, "doc_date")
    rate = fx.effective_rate(F.lit(0.0), F.col("xchg_rate"))
    return j.select(
        F.md5(F.concat_ws("|", "doc_number", "item_number", "from_location_code",
                          F.col("doc_type").cast("string"), F.col("trx_qty").cast("string"))).alias("transaction_sk"),
        date_sk(F.col("doc_date")).alias("trx_date_sk"),
        F.md5("item_number").alias("product_sk"),
        F.md5("from_location_code").alias("from_location_sk"),
        F.md5("to_location_code").alias("to_location_sk"),
        "doc_type", "doc_type_desc", "doc_number", "trx_qty",
        rnd(F.col("unit_cost_vef").cast("double") / rate, 4).alias("unit_cost_usd"),
        rnd(F.col("extended_cost_vef").cast("double") / rate, 2).alias("extended_cost_usd"),
    )
