"""PII masking (G07) and role projections (G08) as column expressions.

Masking is done with built-in string and hash functions in the scan stage —
no UDF, no shuffle.  Roles are functions that return a filtered and projected
DataFrame; enforcement (grants) is left to the catalog.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .sales import apply_filters, money_sum


def mask_name(c: Column) -> Column:
    """``Juan Perez`` → ``Juan P***``; a single word keeps its first letter."""
    two_words = F.regexp_extract(c, r"^(\S+\s+\S)", 1)
    first = F.substring(c, 1, 1)
    return F.when(c.isNull(), F.lit(None).cast("string")) \
        .when(two_words != "", F.concat(two_words, F.lit("***"))) \
        .otherwise(F.concat(first, F.lit("***")))


def mask_phone(c: Column) -> Column:
    """Every digit except those in the last four characters replaced by ``*``."""
    n = F.length(c)
    head = F.substring(c, F.lit(1), n - 4)
    return (F.when(n > 4, F.concat(F.regexp_replace(head, r"[0-9]", "*"), F.right(c, F.lit(4))))
            .otherwise(F.regexp_replace(c, r"[0-9]", "*")))


def hash_value(c: Column) -> Column:
    return F.sha2(c.cast("string"), 256)


def customer_masked(stg_customers: DataFrame) -> DataFrame:
    """Customer master for open analytics — partial name, SHA-256 contact,
    phones keep the last 4, fax fully masked, checkbook and credit dropped."""
    return stg_customers.select(
        "customer_id",
        mask_name(F.col("customer_name")).alias("customer_name"),
        hash_value(F.col("primary_contact_person")).alias("primary_contact_hash"),
        mask_phone(F.col("phone_number_1")).alias("phone_number_1"),
        mask_phone(F.col("phone_number_2")).alias("phone_number_2"),
        F.regexp_replace("fax_number", r"[0-9]", "*").alias("fax_number"),
        "city", "state", "country", "customer_class_id", "salesperson_id", "territory_id",
    )


def role_view_sales(fact: DataFrame, territory: str) -> DataFrame:
    """G08 sales executive: full rows, own territory only."""
    return apply_filters(fact, territory=territory)


def role_view_analyst(fact: DataFrame, customers: DataFrame) -> DataFrame:
    """G08 BI analyst: full financial metrics per customer, masked identity."""
    t = fact.groupBy("customer_id").agg(
        money_sum("net_sales_amount").cast("double").alias("net_sales"),
        money_sum("gross_profit_amount").cast("double").alias("gross_profit"),
        F.countDistinct("invoice_number").alias("orders"))
    c = customers.select("customer_id", mask_name(F.col("customer_name")).alias("customer_name"),
                         "customer_class_id", "territory_name", mask_phone(F.col("phone")).alias("phone"))
    return c.join(t, "customer_id", "left")


def role_view_scientist(snapshot: DataFrame) -> DataFrame:
    """G08 data scientist: hashed customer token, monthly aggregated facts."""
    return snapshot.select(
        hash_value(F.col("customer_id")).alias("customer_token"), "year_month_sk", "active_month_flag",
        "is_churned_flag", "is_new_customer_flag", "net_sales_month", "gross_profit_month",
        "cumulative_net_sales_ltv", "cumulative_gross_profit_ltv", "days_since_last_purchase")


def role_customers_sales(dim_customer: DataFrame, territory_id: str) -> DataFrame:
    """G08 sales executive on the customer dimension: all attributes, own territory only."""
    return dim_customer.where(F.col("territory_id") == territory_id)


def role_customers_analyst(dim_customer: DataFrame) -> DataFrame:
    """G08 BI analyst on the customer dimension: names and phones masked, contacts hashed, no address or credit."""
    return dim_customer.where("is_current").select(
        "customer_sk", "customer_id", mask_name(F.col("customer_name")).alias("customer_name"), "customer_class_id",
        "customer_class_desc", hash_value(F.col("primary_contact")).alias("primary_contact_hash"), "city", "country",
        mask_phone(F.col("phone_number")).alias("phone_number"), "salesperson_id", "territory_id")


def role_customers_scientist(dim_customer: DataFrame) -> DataFrame:
    """G08 data scientist on the customer dimension: a token for the customer, no identifying attribute."""
    return dim_customer.where("is_current").select(
        hash_value(F.col("customer_id")).alias("customer_token"), "customer_class_id", "country", "territory_id",
        "is_inactive_source")


def role_fact_scientist(fact_sales: DataFrame) -> DataFrame:
    """G08 data scientist on the sales fact: aggregated by month, product and territory."""
    month = (F.col("document_date_sk") / 100).cast("int").alias("year_month")
    return fact_sales.groupBy(month, "product_sk", "territory_sk").agg(
        F.sum("quantity").alias("quantity"), F.sum("net_sales_amount").alias("net_sales_amount"),
        F.sum("gross_profit_amount").alias("gross_profit_amount"), F.count(F.lit(1)).alias("n_lines"))


def role_view_auditor(sop30200: DataFrame, sop30300: DataFrame) -> DataFrame:
    """G08 financial auditor: full read, each non-voided document's header
    subtotal reconciled with the sum of its source lines (aggregated per
    document before the join)."""
    lines = sop30300.groupBy(F.col("SOPTYPE").alias("_t"), F.trim("SOPNUMBE").alias("_k")).agg(
        F.sum("XTNDPRCE").alias("_sum"))
    h = sop30200.where(F.col("VOIDSTTS") == 0)
    j = h.join(lines, (F.col("SOPTYPE") == F.col("_t")) & (F.trim("SOPNUMBE") == F.col("_k")), "left")
    total = F.coalesce("_sum", F.lit(0))
    return j.select(
        F.rtrim("SOPNUMBE").alias("invoice_number"), F.col("SOPTYPE").alias("sop_type"),
        F.rtrim("CUSTNMBR").alias("customer_id"), F.col("DOCDATE").cast("date").alias("document_date"),
        F.col("SUBTOTAL").cast("double").alias("header_subtotal"), total.cast("double").alias("lines_total"),
        (F.col("SUBTOTAL") - total).cast("double").alias("difference"), (F.col("SUBTOTAL") == total).alias("reconciled"))
