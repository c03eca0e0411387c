"""Directory features of the dashboard re-expressed as DataFrame operators:
filter facets (V13), salespeople per territory (V14), case-insensitive
multi-column search (V26) and the CSV export rows (S06–S08).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import labels as L

ALL = "ALL"


def search(df: DataFrame, query: str, columns: Sequence[str]) -> DataFrame:
    """Rows where any of ``columns`` contains ``query`` ignoring case."""
    q = query.lower()
    cond = F.lit(False)
    for c in columns:
        cond = cond | F.coalesce(F.lower(F.col(c)).contains(q), F.lit(False))
    return df.where(cond)


def search_customers(customers: DataFrame, query: str) -> DataFrame:
    return search(customers, query, ("customer_id", "customer_name", "territory_name", "customer_class_id"))


def search_inventory(items: DataFrame, query: str, health: str = ALL) -> DataFrame:
    d = search(items, query, ("item_number", "item_description", "category", "sku_type"))
    if health and health != ALL:
        d = d.where(F.col("health_status") == health)
    return d


def search_receivables(directory: DataFrame, query: str, aging: str = ALL) -> DataFrame:
    d = search(directory, query, ("customer_id", "customer_name", "territory_name", "salesperson_name"))
    od = F.coalesce(F.col("overdue_debt_usd"), F.lit(0.0))
    if aging == "OVERDUE":
        d = d.where(od > 0)
    elif aging == "CURRENT":
        d = d.where(od <= 0)
    return d


def _valid_salesperson(c) -> F.Column:
    return c.isNotNull() & (c != "") & (c != L.SERVICE_UNASSIGNED) & ~c.contains(L.FACET_INACTIVE_MARK)


def filter_facets(fact: DataFrame, items: DataFrame) -> DataFrame:
    """Long table (facet, value) of filter options plus the date range.

    The fact is read once: one group per (territory, class, salesperson) with
    its first and last date; the facets are exploded from those few groups."""
    groups = fact.groupBy("territory_name", "customer_class_id", "salesperson_name").agg(
        F.min("document_date").alias("lo"), F.max("document_date").alias("hi"))
    t, c, sp = F.col("territory_name"), F.col("customer_class_id"), F.col("salesperson_name")

    def option(name, value, wanted, kind=0):
        return F.struct(F.lit(name).alias("facet"), F.lit(kind).alias("kind"),
                        F.when(wanted, value).alias("value"))

    options = F.array(
        option("territory", t, t.isNotNull() & (t != "") & ~t.isin(*L.FACET_EXCLUDED_TERRITORIES)),
        option("customer_class", c, c.isNotNull() & (c != "")),
        option("salesperson", sp, _valid_salesperson(sp)),
        option("min_date", F.date_format("lo", "yyyy-MM-dd"), F.lit(True), 1),
        option("max_date", F.date_format("hi", "yyyy-MM-dd"), F.lit(True), 2))
    found = groups.select(F.explode(options).alias("o")).select("o.*")
    cat = items.where(F.col("category").isNotNull() & (F.col("category") != "")) \
        .select(F.lit("inventory_category").alias("facet"), F.lit(0).alias("kind"), F.col("category").alias("value"))
    # dates keep one value per facet, options every value
    keyed = found.where((F.col("kind") > 0) | F.col("value").isNotNull()).unionByName(cat)
    keyed = keyed.groupBy("facet", "kind", F.when(F.col("kind") == 0, F.col("value")).alias("own")).agg(
        F.min("value").alias("lo"), F.max("value").alias("hi"))
    return keyed.select("facet", F.when(F.col("kind") == 2, F.col("hi")).otherwise(F.col("lo")).alias("value")) \
        .orderBy("facet", "value")


def salespeople_by_territory_pairs(fact: DataFrame) -> DataFrame:
    """V14 (flat): distinct (territory, salesperson) pairs, sorted.

    Unlike the facets (V13), blank names are kept here: only NULLs, the
    unassigned label and inactive salespeople are excluded."""
    sp = F.col("salesperson_name")
    keep = (F.col("territory_name").isNotNull() & sp.isNotNull() & (sp != L.SERVICE_UNASSIGNED)
            & ~sp.contains(L.FACET_INACTIVE_MARK))
    d = fact.where(keep).select("territory_name", "salesperson_name").distinct()
    return d.orderBy("territory_name", "salesperson_name")


def salespeople_by_territory(fact: DataFrame) -> DataFrame:
    """Territory → sorted list of its salespeople (lists are bounded by staff)."""
    pairs = salespeople_by_territory_pairs(fact)
    return pairs.groupBy("territory_name").agg(F.sort_array(F.collect_set("salesperson_name")).alias("salespeople"))


# ------------------------------------------------------------------ S06–S08
def export_customers(segments: DataFrame) -> DataFrame:
    """customer/RFM directory rows with the export header names."""
    return segments.orderBy(F.desc("gross_profit_ltv"), "customer_id", "customer_name", "customer_class_id",
                            "territory_name", "salesperson_name").select(
        F.col("customer_id").alias("Codigo_Cliente"), F.col("customer_name").alias("Nombre_Cliente"),
        F.col("customer_class_id").alias("Clase"), F.col("territory_name").alias("Zona"),
        F.col("rfm_segment").alias("Segmento_RFM"), F.col("total_orders").alias("Total_Pedidos"),
        F.col("total_net_sales").alias("Ventas_USD"), F.col("customer_ltv_gross_profit").alias("LTV_USD"),
        F.col("recency_days").alias("Recencia_Dias"))


def export_inventory(items: DataFrame) -> DataFrame:
    """Inventory directory rows with the export header names."""
    return items.orderBy(F.desc("total_valuation_usd"), "item_number").select(
        F.col("item_number").alias("Codigo_Articulo"), F.col("item_description").alias("Descripcion"),
        F.col("sku_type").alias("Tipo_SKU"), F.col("category").alias("Categoria"),
        F.col("qty_on_hand").alias("Stock_Fisico"), F.col("qty_allocated").alias("Comprometido"),
        F.col("qty_available").alias("Disponible"), F.col("qty_on_order").alias("En_Transito"),
        F.col("unit_cost_usd").alias("Costo_Unitario_USD"), F.col("total_valuation_usd").alias("Valoracion_USD"),
        F.col("inventory_turnover").alias("Rotacion_Turnover"), F.col("dio").alias("DIO_Dias"),
        F.col("health_status").alias("Estado_Salud"))


def export_receivables(directory: DataFrame) -> DataFrame:
    """Receivables directory rows with the export header names."""
    return directory.select(
        F.col("customer_id").alias("Codigo_Cliente"), F.col("customer_name").alias("Nombre_Cliente"),
        F.col("territory_name").alias("Zona"), F.col("salesperson_name").alias("Vendedor"),
        F.col("total_debt_usd").alias("Saldo_Total_USD"), F.col("current_debt_usd").alias("Saldo_Al_Dia_USD"),
        F.col("overdue_debt_usd").alias("Saldo_Vencido_USD"), F.col("credit_limit_usd").alias("Limite_Credito_USD"),
        F.col("credit_utilization_pct").alias("Utilizacion_Pct"), F.col("max_overdue_days").alias("Max_Atraso_Dias"),
        F.col("risk_status").alias("Estado_Riesgo"), F.col("docs_count").alias("Total_Documentos"))
