"""Conformed dimensions (M11, M12, S09, M22) with md5 surrogate keys.

Dimension frames are master data: built by projection + one left lookup, no
shuffle of fact data.  Surrogate keys are md5 hex strings of the natural key
so that they are stable across rebuilds and joinable without a sequence
generator.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import labels as L
from ..plans.broadcast import small

TS_FORMAT = "yyyy-MM-dd HH:mm:ss"
VALID_TO = "9999-12-31 23:59:59"
DEFAULT_VALID_FROM = "2000-01-01 00:00:00"


def ts(text: str) -> Column:
    """Timestamp literal in the session time zone (UTC)."""
    return F.lit(text).cast("timestamp")


def md5_of(*parts: Column) -> Column:
    return F.md5(F.concat(*parts))


def unknown_key(name: str) -> Column:
    """Surrogate key of an unknown member, e.g. ``md5('UNKNOWN_SP')``."""
    return F.md5(F.lit(name))


def row_hash(side: str = "") -> Column:
    """md5 over the tracked attributes (output only: it equates NULL and '');
    ``side`` is the alias of a joined frame."""
    def of(name: str) -> Column:
        return F.col(f"{side}.{name}" if side else name)

    return F.md5(F.concat_ws(
        "|", of("customer_name"), *[F.coalesce(of(c), F.lit("")) for c in ("customer_class_id", "salesperson_id",
                                                                          "territory_id")],
        of("credit_limit_amount").cast("string")))


def dim_customer(stg_customers: DataFrame, stg_classes: DataFrame) -> DataFrame:
    """Current customer dimension (one row per customer, ``is_current``)."""
    cl = small(stg_classes.select(F.col("customer_class_id").alias("cl_id"), "customer_class_description"))
    c = stg_customers.join(cl, stg_customers["customer_class_id"] == cl["cl_id"], "left")
    modified = F.coalesce(F.date_format("modified_at", TS_FORMAT), F.lit("INITIAL"))
    return c.select(
        md5_of(F.col("customer_id"), F.lit("_"), modified).alias("customer_sk"),
        "customer_id", "customer_name",
        F.coalesce("customer_class_id", F.lit(L.CLASS_UNKNOWN)).alias("customer_class_id"),
        F.coalesce("customer_class_description", F.lit(L.CLASS_UNKNOWN_DESC)).alias("customer_class_desc"),
        "corporate_customer_id", F.col("primary_contact_person").alias("primary_contact"), "address_line1", "city",
        "state", "zip_code", "country", F.col("phone_number_1").alias("phone_number"),
        F.coalesce("salesperson_id", F.lit(L.UNKNOWN_SP)).alias("salesperson_id"),
        F.coalesce("territory_id", F.lit(L.UNKNOWN_TERR)).alias("territory_id"),
        "payment_terms_id",
        F.coalesce("credit_limit_amount", F.lit(0).cast("decimal(19,2)")).alias("credit_limit_amount"),
        "credit_limit_type", F.col("is_inactive").alias("is_inactive_source"),
        F.coalesce("created_at", ts(DEFAULT_VALID_FROM)).alias("valid_from"),
        ts(VALID_TO).alias("valid_to"),
        F.lit(True).alias("is_current"),
        row_hash().alias("row_hash"),
    )


def dim_product(stg_items: DataFrame) -> DataFrame:
    """Product dimension."""
    return stg_items.select(
        F.md5("item_number").alias("product_sk"), "item_number", "item_description",
        F.coalesce("item_class_code", F.lit(L.ITEM_CLASS_UNASSIGNED)).alias("item_class_code"),
        F.coalesce("item_generic_description", F.lit(L.ITEM_GENERIC_DEFAULT)).alias("item_generic_desc"),
        F.coalesce("standard_cost", F.lit(0).cast("decimal(19,4)")).alias("standard_cost"),
        F.coalesce("current_cost", F.lit(0).cast("decimal(19,4)")).alias("current_cost"),
        "uom_schedule",
        F.coalesce("decimal_places_qty", F.lit(2)).alias("decimal_places_qty"),
        F.coalesce("decimal_places_curr", F.lit(2)).alias("decimal_places_curr"),
        F.when(F.col("is_inactive") == 1, 0).otherwise(1).alias("is_active"),
    )


def dim_salesperson(stg_salespeople: DataFrame) -> DataFrame:
    """Salesperson dimension."""
    return stg_salespeople.select(
        F.md5("salesperson_id").alias("salesperson_sk"), "salesperson_id", "employee_id", "full_name", "job_title",
        F.coalesce("territory_id", F.lit(L.UNKNOWN_TERR)).alias("territory_id"),
        F.coalesce("commission_pct", F.lit(0.0)).alias("commission_pct"), "is_inactive",
    )


def dim_territory(stg_territories: DataFrame) -> DataFrame:
    """Territory dimension."""
    return stg_territories.select(
        F.md5("territory_id").alias("territory_sk"), "territory_id", "territory_description", "manager_full_name",
        "country", "is_inactive",
    )


def date_rows(spark: SparkSession, start, days: int | None = None, end=None) -> DataFrame:
    """Calendar spine, ``days`` rows from ``start`` (or ``start``..``end``).

    The default spine of the model is 2015-01-01 plus 7670 days; callers that
    derive the span from the data pass Column bounds instead.
    """
    s = start if isinstance(start, Column) else F.lit(start)
    if end is None:
        e = F.date_add(s, days - 1)
    else:
        e = end if isinstance(end, Column) else F.lit(end)
    return spark.range(1).select(F.explode(F.sequence(s, e)).alias("full_date"))


def dim_date(calendar: DataFrame) -> DataFrame:
    """M12 date dimension over a calendar frame with a ``full_date`` column.

    ``day_of_week`` is 1 = Sunday … 7 = Saturday; names are English.
    """
    d = F.col("full_date")
    return calendar.select(
        (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int").alias("date_sk"),
        d.alias("full_date"),
        F.dayofmonth(d).alias("day_of_month"),
        F.month(d).alias("month_number"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.quarter(d).alias("quarter_number"),
        F.year(d).alias("year_number"),
        F.dayofweek(d).alias("day_of_week"),
        F.date_format(d, "EEEE").alias("day_name"),
        F.dayofweek(d).isin(1, 7).alias("is_weekend"),
        F.lit(False).alias("is_holiday"),
    )


def data_calendar(*date_cols: tuple[DataFrame, str]) -> DataFrame:
    """Calendar spanning the min..max of the given (frame, date column) pairs.

    Only two scalars (min, max) are aggregated from the data; the spine itself
    is one row per day of the span.
    """
    bounds = None
    for df, c in date_cols:
        b = df.agg(F.min(c).alias("lo"), F.max(c).alias("hi"))
        bounds = b if bounds is None else bounds.unionByName(b)
    span = bounds.agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    return span.select(F.explode(F.sequence("lo", "hi")).alias("full_date"))


def add_member(dim: DataFrame, key_col: str, id_col: str, member: str) -> DataFrame:
    """``dim`` plus the member that facts without a match point to: its id is
    ``member``, its key md5 of it, everything else NULL."""
    row = dim.sparkSession.range(1).select(F.lit(member).alias(id_col), F.md5(F.lit(member)).alias(key_col))
    return dim.unionByName(row, allowMissingColumns=True)


# Special members of the customer dimension.
UNKNOWN_MEMBERS = (
    ("UNKNOWN_CUSTOMER", "-1", "Cliente Desconocido / No Asignado"),
    ("NOT_APPLICABLE", "-2", "No Aplica"),
)


def dim_customer_members(dim: DataFrame) -> DataFrame:
    """Dimension plus the unknown (−1) and not-applicable (−2) members."""
    spark = dim.sparkSession
    extra = spark.createDataFrame([(k, cid, name) for k, cid, name in UNKNOWN_MEMBERS],
                                  "member_key string, customer_id string, customer_name string")
    members = extra.select(
        F.md5("member_key").alias("customer_sk"), "customer_id", "customer_name",
        F.lit(L.CLASS_UNKNOWN).alias("customer_class_id"), F.lit(L.CLASS_UNKNOWN_DESC).alias("customer_class_desc"),
        F.lit(L.UNKNOWN_SP).alias("salesperson_id"), F.lit(L.UNKNOWN_TERR).alias("territory_id"),
        F.lit(0).cast("decimal(19,2)").alias("credit_limit_amount"),
        ts(DEFAULT_VALID_FROM).alias("valid_from"), ts(VALID_TO).alias("valid_to"),
        F.lit(True).alias("is_current"))
    return dim.unionByName(members, allowMissingColumns=True)
