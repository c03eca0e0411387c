"""Service-layer dimensions and the salesperson / territory fallback chain.

The analytics service resolves names through role-playing joins: the same
salesperson table is joined for the document and for the customer, and the
territory table three times (document, document's salesperson, customer).
Each role is its own aliased join; source keys are joined trimmed because the
source database compares padded char keys ignoring trailing blanks (D18).
T-SQL ``a + ' ' + b`` propagates NULL, so plain ``concat`` is used here (D4).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import labels as L
from ..plans.broadcast import small


def _blank_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def person_name(first: Column, last: Column) -> Column:
    """``LTRIM(RTRIM(RTRIM(first) + ' ' + RTRIM(last)))`` with NULL propagation."""
    return F.trim(F.concat(F.rtrim(first), F.lit(" "), F.rtrim(last)))


def salesperson_role(rm00301: DataFrame, prefix: str) -> DataFrame:
    """One role of the salesperson table: key, display name and territory."""
    return small(rm00301.select(
        F.trim("SLPRSNID").alias(f"{prefix}_key"),
        person_name(F.col("SLPRSNFN"), F.col("SPRSNSLN")).alias(f"{prefix}_name"),
        F.rtrim("SALSTERR").alias(f"{prefix}_terr"),
        F.trim("SALSTERR").alias(f"{prefix}_terr_key"),
    ))


def territory_role(rm00303: DataFrame, prefix: str) -> DataFrame:
    """One role of the territory table: key and description."""
    return small(rm00303.select(
        F.trim("SALSTERR").alias(f"{prefix}_key"),
        F.rtrim("SLTERDSC").alias(f"{prefix}_desc"),
    ))


def service_territories(rm00303: DataFrame) -> DataFrame:
    """Territory dimension of the service (territory_id, name, manager)."""
    return rm00303.select(
        F.rtrim("SALSTERR").alias("territory_id"),
        F.rtrim("SLTERDSC").alias("territory_name"),
        F.concat(F.rtrim("STMGRFNM"), F.lit(" "), F.rtrim("STMGRLNM")).alias("manager_name"),
        F.col("INACTIVE").cast("int").alias("is_inactive"),
    )


def service_salespeople(rm00301: DataFrame, rm00303: DataFrame) -> DataFrame:
    """Salesperson dimension of the service with display label and zone."""
    t = territory_role(rm00303, "t")
    sp = rm00301.join(t, F.trim(rm00301["SALSTERR"]) == t["t_key"], "left")
    name = person_name(F.col("SLPRSNFN"), F.col("SPRSNSLN"))
    return sp.select(
        F.rtrim("SLPRSNID").alias("salesperson_id"),
        F.rtrim("SLPRSNFN").alias("first_name"),
        F.rtrim("SPRSNSLN").alias("last_name"),
        name.alias("salesperson_name"),
        F.concat(F.lit("["), F.rtrim("SLPRSNID"), F.lit("] "), name).alias("salesperson_display"),
        F.rtrim("SALSTERR").alias("territory_id"),
        F.coalesce(F.col("t_desc"), F.lit(L.SERVICE_NO_ZONE_ASSIGNED)).alias("territory_name"),
        F.col("INACTIVE").cast("int").alias("is_inactive"),
    )


def service_customers(rm00101: DataFrame, rm00301: DataFrame, rm00303: DataFrame) -> DataFrame:
    """Customer dimension of the service with resolved salesperson and zone names."""
    sp = salesperson_role(rm00301, "sp")
    t = territory_role(rm00303, "t")
    t_sp = territory_role(rm00303, "tsp")
    c = (rm00101
         .join(sp, F.trim(rm00101["SLPRSNID"]) == sp["sp_key"], "left")
         .join(t, F.trim(rm00101["SALSTERR"]) == t["t_key"], "left")
         .join(t_sp, F.col("sp_terr_key") == t_sp["tsp_key"], "left"))
    return c.select(
        F.rtrim("CUSTNMBR").alias("customer_id"),
        F.rtrim("CUSTNAME").alias("customer_name"),
        F.coalesce(_blank_to_null(F.rtrim("CUSTCLAS")), F.lit(L.SERVICE_GENERAL)).alias("customer_class_id"),
        F.coalesce(_blank_to_null(F.rtrim("SLPRSNID")), F.lit(L.SERVICE_NO_SALESPERSON_ID)).alias("salesperson_id"),
        F.coalesce(_blank_to_null(F.col("sp_name")), F.rtrim("SLPRSNID"),
                   F.lit(L.SERVICE_UNASSIGNED)).alias("salesperson_name"),
        F.coalesce(_blank_to_null(F.col("t_desc")), _blank_to_null(F.col("tsp_desc")),
                   F.rtrim("SALSTERR"), F.lit(L.SERVICE_NO_ZONE)).alias("territory_name"),
        F.coalesce(_blank_to_null(F.rtrim("SALSTERR")), F.col("sp_terr"), F.lit("0")).alias("territory_id"),
        F.col("CRLMTAMT").cast("double").alias("credit_limit"),
        F.col("CREATDDT").cast("date").alias("created_at"),
        F.rtrim("PHONE1").alias("phone"),
        F.rtrim("CITY").alias("city"),
        F.col("INACTIVE").cast("int").alias("is_inactive_source"),
    )


def resolve_sales_org(docs: DataFrame, rm00101: DataFrame, rm00301: DataFrame, rm00303: DataFrame,
                      cust_col: str = "CUSTNMBR", sp_col: str = "SLPRSNID", terr_col: str = "SALSTERR") -> DataFrame:
    """M04 on any document frame: adds customer class, salesperson id/name and
    territory id/name by the document → customer → salesperson → raw id → literal
    chain.  Keeps every input column; all lookups are left joins (1:1 by key)."""
    cust = small(rm00101.select(
        F.trim("CUSTNMBR").alias("c_key"),
        F.rtrim("CUSTCLAS").alias("c_class"),
        F.rtrim("SLPRSNID").alias("c_sp"),
        F.trim("SLPRSNID").alias("c_sp_key"),
        F.rtrim("SALSTERR").alias("c_terr"),
        F.trim("SALSTERR").alias("c_terr_key"),
    ))
    sp = salesperson_role(rm00301, "sp")
    sp_c = salesperson_role(rm00301, "spc")
    t = territory_role(rm00303, "t")
    t_sp = territory_role(rm00303, "tsp")
    t_c = territory_role(rm00303, "tc")
    j = (docs
         .join(cust, F.trim(docs[cust_col]) == cust["c_key"], "left")
         .join(sp, F.trim(docs[sp_col]) == sp["sp_key"], "left")
         .join(sp_c, F.col("c_sp_key") == sp_c["spc_key"], "left")
         .join(t, F.trim(docs[terr_col]) == t["t_key"], "left")
         .join(t_sp, F.col("sp_terr_key") == t_sp["tsp_key"], "left")
         .join(t_c, F.col("c_terr_key") == t_c["tc_key"], "left"))
    return j.select(
        *[F.col(c) for c in docs.columns],
        F.coalesce(_blank_to_null(F.col("c_class")), F.lit(L.SERVICE_GENERAL)).alias("customer_class_id"),
        F.trim(F.coalesce(_blank_to_null(F.col("sp_name")), _blank_to_null(F.col("spc_name")),
                          F.rtrim(docs[sp_col]), F.lit(L.SERVICE_UNASSIGNED))).alias("salesperson_name"),
        F.coalesce(_blank_to_null(F.rtrim(docs[sp_col])), F.col("c_sp"),
                   F.lit(L.SERVICE_NO_SALESPERSON_ID)).alias("salesperson_id"),
        F.trim(F.coalesce(_blank_to_null(F.col("t_desc")), _blank_to_null(F.col("tsp_desc")),
                          _blank_to_null(F.col("tc_desc")), F.rtrim(docs[terr_col]),
                          F.lit(L.SERVICE_NO_ZONE))).alias("territory_name"),
        F.coalesce(_blank_to_null(F.rtrim(docs[terr_col])), F.col("sp_terr"), F.col("c_terr"),
                   F.lit("0")).alias("territory_id"),
    )
