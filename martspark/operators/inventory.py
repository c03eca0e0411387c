"""Inventory: model-layer valuation (M10), receipt-layer valuation (M21) and the
service-layer item metrics, KPIs and breakdowns (V15–V18).

The latest exchange rate is a scalar subquery (computed once, no join); the
12-month COGS per item is an algebraic aggregate over the sales lines (partial
aggregation before the shuffle on item).  Two label/threshold variants exist
(D15, D16) and are kept per layer:

* model (``inventory_valuation``): unit cost = coalesce(current, standard, 0);
  demand test on 90-day quantity; unrounded DIO in the rules; label "Óptimo".
  COGS is converted to USD with the same rate as the valuation (D3: the model
  text sums local-currency cost; converting keeps turnover and DIO unit-free).
* service (``inventory_items``): current cost 0 counts as missing; 12-month
  units; unit cost rounded to 4 places before valuation; rounded DIO in the
  rules; label "Nivel Óptimo".
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import labels as L
from ..functions.numeric import ratio_or, rnd
from ..plans.broadcast import small
from .sales import _date, dated_from, money_sum

ALL = "ALL"


def latest_model_rate(stg_fx: DataFrame) -> Column:
    """``top 1 exchange_rate order by exchange_date desc`` as a scalar (double)."""
    return stg_fx.select(F.max_by(F.col("exchange_rate").cast("double"), "exchange_date")).scalar()


# ----------------------------------------------------------------------- M10
def inventory_valuation(stg_quantities: DataFrame, stg_items: DataFrame, enriched: DataFrame, stg_fx: DataFrame,
                        as_of, critical_days: int = 15, excess_days: int = 180) -> DataFrame:
    """Item-total stock valued in USD with turnover, DIO and health label."""
    today = _date(as_of)
    fx_rate = latest_model_rate(stg_fx)
    stock = stg_quantities.where(F.col("record_type") == 1)
    items = small(stg_items.select(F.col("item_number").alias("i_item"), "item_description",
                                   F.col("item_class_code").alias("category"), "current_cost", "standard_cost"))
    # both figures look back at most 12 months; the left join turns absent into 0
    cogs = enriched.where(F.col("document_date") >= F.add_months(today, -12)).groupBy(
        F.col("item_number").alias("c_item")).agg(
        F.sum(F.when(F.col("document_date") >= F.add_months(today, -12), F.col("total_cost_amount"))
              .otherwise(F.lit(0))).alias("cogs_vef"),
        F.sum(F.when(F.col("document_date") >= F.add_months(today, -3), F.col("net_quantity"))
              .otherwise(F.lit(0))).alias("qty_sold_last_90d_raw"),
    )
    j = (stock.join(items, stock["item_number"] == items["i_item"], "left")
         .join(cogs, stock["item_number"] == cogs["c_item"], "left"))
    unit_cost = F.coalesce(F.col("current_cost"), F.col("standard_cost"), F.lit(0).cast("decimal(19,4)"))
    j = j.withColumn("_fx", F.nullif(fx_rate, F.lit(0.0)))  # scalar subquery evaluated once
    fx_nz = F.col("_fx")
    uc_usd = unit_cost.cast("double") / fx_nz
    val_raw = F.col("qty_on_hand").cast("double") * uc_usd
    cogs_usd = F.coalesce(F.col("cogs_vef").cast("double") / fx_nz, F.lit(0.0))
    dio_raw = val_raw / F.nullif(cogs_usd / F.lit(365.0), F.lit(0.0))
    qty90 = F.coalesce(F.col("qty_sold_last_90d_raw"), F.lit(0))
    health = (F.when((F.col("qty_available") <= 0) & (qty90 > 0), L.HEALTH_STOCKOUT)
              .when((F.col("qty_available") < F.col("safety_stock_qty")) | ((cogs_usd > 0) & (dio_raw < critical_days)),
                    L.HEALTH_CRITICAL)
              .when(((cogs_usd > 0) & (dio_raw > excess_days)) | (cogs_usd == 0), L.HEALTH_EXCESS)
              .otherwise(L.HEALTH_OPTIMAL_MODEL))
    return j.select(
        "item_number", "item_description", "category", "qty_on_hand", "qty_allocated", "qty_available",
        "qty_on_order", "safety_stock_qty", "reorder_point_qty",
        unit_cost.alias("unit_cost_vef_used"),
        rnd(uc_usd, 4).alias("unit_cost_usd"),
        rnd(val_raw, 2).alias("total_valuation_usd"),
        cogs_usd.alias("annual_cogs_usd"),
        qty90.alias("qty_sold_last_90d"),
        F.when(val_raw > 0, rnd(cogs_usd / val_raw, 2)).otherwise(F.lit(0.0)).alias("inventory_turnover"),
        F.when(cogs_usd > 0, rnd(dio_raw, 1)).otherwise(F.lit(999.0)).alias("days_inventory_outstanding"),
        health.alias("stock_health_status"),
    )


# ----------------------------------------------------------------------- M21
def layer_valuation(stg_layers: DataFrame, stg_fx: DataFrame) -> DataFrame:
    """Remaining receipt layers valued at receipt cost, per item × site."""
    fx_rate = latest_model_rate(stg_fx)
    g = stg_layers.groupBy("item_number", "location_code").agg(
        F.count(F.lit(1)).alias("open_layers"),
        F.sum("qty_on_hand_layer").alias("layer_qty_on_hand"),
        F.sum(F.col("qty_on_hand_layer") * F.col("unit_cost_vef")).alias("layer_value_vef"),
        F.min("date_received").alias("oldest_layer_date"),
    )
    return g.select("*", rnd(F.col("layer_value_vef").cast("double") / F.nullif(fx_rate, F.lit(0.0)), 2)
                    .alias("layer_value_usd"))


# ------------------------------------------------------------------- service
def item_cogs_12m(sop30200: DataFrame, sop30300: DataFrame, as_of, months: int = 12) -> DataFrame:
    """Signed units and local-currency COGS per item over the last ``months``."""
    start = F.add_months(_date(as_of), -months)
    h = sop30200.where(F.col("SOPTYPE").isin(3, 4) & (F.col("VOIDSTTS") == 0) & (F.col("DOCDATE") >= start)) \
        .select(F.col("SOPTYPE").alias("h_type"), F.trim("SOPNUMBE").alias("h_key"))
    line = sop30300.where(dated_from(start)).select(
        F.col("SOPTYPE").alias("l_type"), F.trim("SOPNUMBE").alias("l_key"), "ITEMNMBR", "QUANTITY", "EXTDCOST")
    j = line.join(h, (line["l_type"] == h["h_type"]) & (line["l_key"] == h["h_key"]))
    sign = F.when(F.col("h_type") == 4, F.lit(-1.0).cast("decimal(2,1)")).otherwise(F.lit(1.0).cast("decimal(2,1)"))
    g = j.groupBy(F.rtrim("ITEMNMBR").alias("item_number")).agg(
        F.sum(sign * F.col("QUANTITY")).alias("units"), F.sum(sign * F.col("EXTDCOST")).alias("cogs"))
    return g.select("item_number", F.col("units").cast("double").alias("annual_units_sold"),
                    F.col("cogs").cast("double").alias("annual_cogs_vef"))


def sku_type(category: Column) -> Column:
    c = F.upper(F.trim(category))
    return F.when(c == "MP", "MP").when(c == "ME", "ME").otherwise("PT")


def sku_type_desc(category: Column) -> Column:
    t = sku_type(category)
    expr = F.lit(L.SKU_TYPE_DESC["PT"])
    for k in ("MP", "ME"):
        expr = F.when(t == k, F.lit(L.SKU_TYPE_DESC[k])).otherwise(expr)
    return expr


def service_stock(iv00102: DataFrame, iv00101: DataFrame) -> DataFrame:
    """Stock rows of the service (inner join to items, service naming)."""
    i = small(iv00101.select(F.trim("ITEMNMBR").alias("i_key"), F.rtrim("ITEMDESC").alias("item_description"),
                             F.coalesce(F.nullif(F.rtrim("ITMCLSCD"), F.lit("")), F.lit(L.SERVICE_GENERAL)).alias("category"),
                             F.coalesce(F.nullif(F.col("CURRCOST"), F.lit(0)), F.col("STNDCOST"),
                                        F.lit(0).cast("decimal(19,4)")).cast("double").alias("unit_cost_vef")))
    s = iv00102.join(i, F.trim(iv00102["ITEMNMBR"]) == i["i_key"])
    return s.select(
        F.rtrim("ITEMNMBR").alias("item_number"), "item_description", "category",
        F.coalesce(F.nullif(F.rtrim("LOCNCODE"), F.lit("")), F.lit(L.TOTAL_LOCATION)).alias("location_code"),
        F.col("RCRDTYPE").alias("record_type"),
        F.col("QTYONHND").cast("double").alias("qty_on_hand"),
        F.col("ATYALLOC").cast("double").alias("qty_allocated"),
        (F.col("QTYONHND") - F.col("ATYALLOC")).cast("double").alias("qty_available"),
        F.col("QTYONORD").cast("double").alias("qty_on_order"),
        F.col("SFTYSTCKQTY").cast("double").alias("safety_stock"),
        F.col("ORDRPNTQTY").cast("double").alias("reorder_point"),
        "unit_cost_vef",
        sku_type(F.col("category")).alias("sku_type"),
    )


def inventory_items(stock: DataFrame, cogs12: DataFrame, latest_rate: Column,
                    critical_days: int = 15, excess_days: int = 180) -> DataFrame:
    """Item-total rows with USD cost, valuation, COGS, turnover, DIO, health."""
    t = stock.where(F.col("record_type") == 1)
    j = t.join(cogs12, "item_number", "left").na.fill(0.0, ["annual_units_sold", "annual_cogs_vef"])
    j = j.withColumn("_fx", latest_rate)  # scalar subquery evaluated once
    j = j.withColumn("unit_cost_usd", rnd(F.col("unit_cost_vef") / F.col("_fx"), 4))
    j = j.withColumn("total_valuation_usd", rnd(F.col("qty_on_hand") * F.col("unit_cost_usd"), 2))
    j = j.withColumn("annual_cogs_usd", rnd(F.col("annual_cogs_vef") / F.col("_fx"), 2)).drop("_fx")
    val, cogs = F.col("total_valuation_usd"), F.col("annual_cogs_usd")
    daily = cogs / F.lit(365.0)
    j = j.select("*", sku_type_desc(F.col("category")).alias("sku_type_desc"),
                 F.when(val > 0, rnd(cogs / val, 2)).otherwise(F.lit(0.0)).alias("inventory_turnover"),
                 F.when(daily > 0, rnd(val / daily, 1)).otherwise(F.lit(999.0)).alias("dio"))
    dio = F.col("dio")
    health = (F.when((F.col("qty_available") <= 0) & (F.col("annual_units_sold") > 0), L.HEALTH_STOCKOUT)
              .when((F.col("qty_available") < F.col("safety_stock")) | ((cogs > 0) & (dio < critical_days)),
                    L.HEALTH_CRITICAL)
              .when((dio > excess_days) | (cogs == 0), L.HEALTH_EXCESS)
              .otherwise(L.HEALTH_OPTIMAL_SERVICE))
    return j.withColumn("health_status", health)


def filter_sku(df: DataFrame, sku: str | None = ALL, category: str | None = ALL) -> DataFrame:
    if sku and sku != ALL:
        df = df.where(F.col("sku_type") == sku)
    if category and category != ALL:
        df = df.where(F.col("category") == category)
    return df


def inventory_kpis(items: DataFrame, latest_rate: Column, sku: str = ALL, category: str = ALL) -> DataFrame:
    """One-row inventory KPIs (DIO = 365 ÷ rounded turnover, 0 without turnover, D24)."""
    d = filter_sku(items, sku, category)
    g = d.agg(
        money_sum("total_valuation_usd").cast("double").alias("total_valuation_usd"),
        money_sum("annual_cogs_usd").cast("double").alias("annual_cogs_usd"),
        money_sum("qty_on_hand", 4).cast("double").alias("total_units_on_hand"),
        money_sum("qty_on_order", 4).cast("double").alias("total_units_on_order"),
        F.count_if(F.col("health_status") == L.HEALTH_STOCKOUT).alias("stockout_items_count"),
        F.count_if(F.col("health_status") == L.HEALTH_CRITICAL).alias("at_risk_items_count"),
        F.count_if(F.col("health_status") == L.HEALTH_OPTIMAL_SERVICE).alias("optimal_items_count"),
        F.count_if(F.col("health_status") == L.HEALTH_EXCESS).alias("excess_items_count"),
        F.count(F.lit(1)).alias("total_items_catalog"),
    )
    val, cogs = F.col("total_valuation_usd"), F.col("annual_cogs_usd")
    g = g.withColumn("inventory_turnover", ratio_or(cogs, val, val > 0, 0.0, 2))
    turn = F.col("inventory_turnover")
    return g.select(
        "total_valuation_usd", "annual_cogs_usd", "total_units_on_hand", "total_units_on_order", "inventory_turnover",
        ratio_or(F.lit(365.0), turn, turn > 0, 0.0, 1).alias("days_inventory_outstanding"),
        "stockout_items_count", "at_risk_items_count", "optimal_items_count", "excess_items_count",
        "total_items_catalog", latest_rate.alias("exchange_rate_applied"), F.lit(sku).alias("sku_type_filter"))


def inventory_by_category(items: DataFrame, sku: str = ALL) -> DataFrame:
    """Valuation, COGS, item count, units and turnover per category."""
    d = filter_sku(items, sku)
    g = d.groupBy("category").agg(
        F.round(money_sum("total_valuation_usd"), 2).cast("double").alias("total_valuation_usd"),
        F.round(money_sum("annual_cogs_usd"), 2).cast("double").alias("annual_cogs_usd"),
        F.count("item_number").alias("items_count"),
        money_sum("qty_on_hand", 4).cast("double").alias("qty_on_hand"),
    )
    val = F.col("total_valuation_usd")
    return g.withColumn("turnover", ratio_or(F.col("annual_cogs_usd"), val, val > 0, 0.0, 2)) \
            .orderBy(F.desc("total_valuation_usd"), "category")


def inventory_by_location(stock: DataFrame, latest_rate: Column, sku: str = ALL) -> DataFrame:
    """Per-warehouse valuation (record type 2), only sites with value > 0."""
    d = stock.where(F.col("record_type") == 2)
    if sku and sku != ALL:
        d = d.where(F.col("sku_type") == sku)
    d = d.withColumn("valuation_usd", rnd(F.col("qty_on_hand") * (F.col("unit_cost_vef") / latest_rate), 2))
    g = d.groupBy("location_code").agg(
        money_sum("valuation_usd").cast("double").alias("total_valuation_usd"),
        money_sum("qty_on_hand", 4).cast("double").alias("total_qty_on_hand"),
        F.countDistinct("item_number").alias("items_count"),
    )
    return g.where(F.col("total_valuation_usd") > 0).orderBy(F.desc("total_valuation_usd"), "location_code")


def inventory_health_summary(items: DataFrame, sku: str = ALL, category: str = ALL) -> DataFrame:
    """Item count and valuation per health label."""
    d = filter_sku(items, sku, category)
    return d.groupBy("health_status").agg(
        F.count("item_number").alias("items_count"),
        F.round(money_sum("total_valuation_usd"), 2).cast("double").alias("valuation_usd"))


def inventory_directory(items: DataFrame, sku: str = ALL, category: str = ALL, health: str = ALL) -> DataFrame:
    """Filtered item directory, most valuable first."""
    d = filter_sku(items, sku, category)
    if health and health != ALL:
        d = d.where(F.col("health_status") == health)
    return d.orderBy(F.desc("total_valuation_usd"), "item_number")


# ----------------------------------------------------------------------- K07
# KPI band labels of the specifications.
DSO_BANDS = ("Nivel Excelente", "Nivel Normal / Aceptable", "Alerta de Iliquidez")
TURNOVER_BANDS = ("Alta rotación", "Rotación estándar", "Baja rotación")


def dso_band(dso: Column, good: float = 45.0, alert: float = 60.0) -> Column:
    return F.when(dso < good, DSO_BANDS[0]).when(dso <= alert, DSO_BANDS[1]).otherwise(DSO_BANDS[2])


def turnover_band(turn: Column, high: float = 6.0, low: float = 2.0) -> Column:
    return F.when(turn > high, TURNOVER_BANDS[0]).when(turn >= low, TURNOVER_BANDS[1]).otherwise(TURNOVER_BANDS[2])
