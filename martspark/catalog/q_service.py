"""Service-layer inventory (V15–V18), receivables (V19–V25), bands (K07/K08),
directories, search and exports (V13, V14, V26, S06–S08)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..mart import mart_for
from ..operators import directory as D
from ..operators import inventory as I
from ..operators import receivables as AR
from ..operators import rfm
from .oracle_base import AS_OF_SQL, with_prelude
from .oracle_common import FACT_USD
from .q_customers import RFM_METRICS
from .q_sales import MS, R
from .registry import register

SVC_INV = f"""
svc_fx as (select arg_max(xchg_rate, exch_date) as r from fx_rates),
-- stock rows 0..3 of a part: all stock, then three warehouses
svc_stock as (
  select g.item_number, g.p_name as item_description, g.category,
    if(RCRDTYPE = 1, 'TOTAL_GENERAL', LOCNCODE) as location_code, RCRDTYPE as record_type,
    QTYONHND::double as qty_on_hand, ATYALLOC::double as qty_allocated, (QTYONHND - ATYALLOC)::double as qty_available,
    QTYONORD::double as qty_on_order, SFTYSTCKQTY::double as safety_stock, ORDRPNTQTY::double as reorder_point,
    (p_retailprice * if(p_partkey % 10 = 0, 0.5, 0.6))::decimal(19,4)::double as unit_cost_vef,
    if(g.category in ('MP', 'ME'), g.category, 'PT') as sku_type
  from IV00102 s join goods g on s.ITEMNMBR = g.item_number || ' ' join part p on p.p_partkey = substr(g.item_number, 2)::bigint),
-- a line's own number and date tell whether its document counts
cogs12 as (
  select ITEMNMBR as item_number, sum(sgn * QUANTITY)::double as annual_units_sold, sum(sgn * EXTDCOST)::double as annual_cogs_vef
  from (select *, if(SOPNUMBE like 'RTN%', -1, 1) as sgn from SOP30300)
  where substr(SOPNUMBE, 4)::bigint % 50 <> 0 and DOCDATE >= {AS_OF_SQL} - interval 12 month group by 1),
inv0 as (
  select s.*, coalesce(c.annual_units_sold, 0.0) as annual_units_sold,
    coalesce(c.annual_cogs_vef, 0.0) as annual_cogs_vef,
    {R('s.unit_cost_vef / (select r from svc_fx)', 4)} as unit_cost_usd
  from svc_stock s left join cogs12 c on s.item_number = c.item_number where s.record_type = 1),
inv1 as (
  select *, {R('qty_on_hand * unit_cost_usd', 2)} as total_valuation_usd,
    {R('annual_cogs_vef / (select r from svc_fx)', 2)} as annual_cogs_usd
  from inv0),
inv2 as (
  select *,
    case sku_type when 'MP' then 'MP - Materia Prima' when 'ME' then 'ME - Material de Empaque'
      else 'PT - Producto Terminado' end as sku_type_desc,
    case when total_valuation_usd > 0 then {R('annual_cogs_usd / total_valuation_usd', 2)} else 0.0 end
      as inventory_turnover,
    case when annual_cogs_usd / 365.0 > 0 then {R('total_valuation_usd / (annual_cogs_usd / 365.0)', 1)}
      else 999.0 end as dio
  from inv1),
inventory_items as (
  select *,
    case when qty_available <= 0 and annual_units_sold > 0 then 'Quiebre de Stock (Stockout)'
         when qty_available < safety_stock or (annual_cogs_usd > 0 and dio < 15) then 'Riesgo Crítico'
         when dio > 180 or annual_cogs_usd = 0 then 'Sobreinventario'
         else 'Nivel Óptimo' end as health_status
  from inv2),
inv_kpis as (
  select {MS('total_valuation_usd')} as total_valuation_usd, {MS('annual_cogs_usd')} as annual_cogs_usd,
    {MS('qty_on_hand', 4)} as total_units_on_hand, {MS('qty_on_order', 4)} as total_units_on_order,
    count(*) filter (where health_status = 'Quiebre de Stock (Stockout)') as stockout_items_count,
    count(*) filter (where health_status = 'Riesgo Crítico') as at_risk_items_count,
    count(*) filter (where health_status = 'Nivel Óptimo') as optimal_items_count,
    count(*) filter (where health_status = 'Sobreinventario') as excess_items_count,
    count(*) as total_items_catalog
  from inventory_items),
inv_kpis2 as (
  select *, case when total_valuation_usd > 0
      then {R('annual_cogs_usd / total_valuation_usd', 2)} else 0.0 end as inventory_turnover
  from inv_kpis)
"""

SVC_AR = f"""
-- receivables of the orders that are neither settled nor void
ar0 as (
  select 'C' || lpad(o_custkey::varchar, 8, '0') as customer_id, b.c_name as customer_name, class as customer_class_id,
    'AR' || lpad(k::varchar, 10, '0') as doc_number, kind as doc_type,
    ['Factura', 'Otro', 'Nota de Débito', 'Otro', 'Otro', 'Otro', 'Nota de Crédito (-)', 'Cobro no Aplicado (-)',
     'Devolución (-)'][kind] as doc_type_desc,
    o_orderdate::date as doc_date, if(k % 97 = 0, null, o_orderdate::date + 30) as due_date,
    o_totalprice::decimal(19,4)::double as orig_amount_vef, o_totalprice::decimal(19,4)::double as current_balance_vef,
    'VEF' as currency_id, coalesce(s.full_name, s.code, '') as salesperson_name,
    case when k % 9 <> 0 then b.nation_name else coalesce(s.zone_name, 'Sin Zona') end as territory_name,
    (greatest(c_acctbal, 0) * 20)::decimal(19,2)::double as credit_limit_vef, if(kind >= 7, -1.0, 1.0) as sgn,
    if(k % 97 = 0, 0, datediff('day', o_orderdate::date + 30, {AS_OF_SQL}))::integer as overdue_days
  from (select *, o_orderkey as k, if(o_orderkey % 10 in (3, 7, 8, 9), o_orderkey % 10, 1)::integer as kind from orders)
  join buyers b on b.c = o_custkey join customer on c_custkey = o_custkey
  left join seller_names s on k % 8 <> 0 and s.s = k % 10
  where k % 23 <> 0 and o_orderstatus <> 'F' and k % 41 <> 0 and o_totalprice > 0),
ar_docs as (
  select * exclude (sgn, overdue_days),
    {R('current_balance_vef / (select r from svc_fx) * sgn', 2)} as balance_usd,
    {R('orig_amount_vef / (select r from svc_fx) * sgn', 2)} as orig_amount_usd,
    {R('credit_limit_vef / (select r from svc_fx)', 2)} as credit_limit_usd,
    overdue_days,
    case when overdue_days <= 0 then 'Corriente / Al Día' when overdue_days <= 30 then 'Vencido 1-30 Días'
         when overdue_days <= 60 then 'Vencido 31-60 Días' when overdue_days <= 90 then 'Vencido 61-90 Días'
         else 'Vencido >90 Días' end as aging_bucket,
    case when overdue_days > 0 then 1 else 0 end as is_overdue
  from ar0),
s90 as (
  select sum((XTNDPRCE - ifnull(MRKDNAMT, 0)) * if(SOPNUMBE like 'RTN%', -1, 1))::double / (select r from svc_fx) as s
  from SOP30300 where substr(SOPNUMBE, 4)::bigint % 50 <> 0 and DOCDATE >= {AS_OF_SQL} - 90),
ar_kpis as (
  select coalesce({MS('balance_usd')}, 0.0) as total_ar_balance_usd,
    cast(coalesce(sum(case when overdue_days > 0 and balance_usd > 0 then cast(balance_usd as decimal(30,2)) end), 0)
         as double) as total_overdue_usd,
    cast(coalesce(sum(case when overdue_days <= 0 and balance_usd > 0 then cast(balance_usd as decimal(30,2)) end), 0)
         as double) as total_current_usd,
    count(distinct case when balance_usd > 0 then customer_id end) as customers_with_debt_count,
    count(distinct doc_number) as open_documents_count
  from ar_docs),
ar_dir as (
  select customer_id, customer_name, customer_class_id, territory_name, salesperson_name,
    cast(round(sum(cast(balance_usd as decimal(30,2))), 2) as double) as total_debt_usd,
    cast(round(coalesce(sum(case when overdue_days > 0 then cast(balance_usd as decimal(30,2)) end), 0), 2) as double)
      as overdue_debt_usd,
    cast(round(coalesce(sum(case when overdue_days <= 0 then cast(balance_usd as decimal(30,2)) end), 0), 2) as double)
      as current_debt_usd,
    max(credit_limit_usd) as credit_limit_usd, count(doc_number) as docs_count, max(overdue_days) as max_overdue_days
  from ar_docs
  where customer_id is not null and customer_name is not null and customer_class_id is not null
    and territory_name is not null and salesperson_name is not null
  group by 1, 2, 3, 4, 5),
ar_directory as (
  select *,
    case when credit_limit_usd > 0 then {R('total_debt_usd * 100 / credit_limit_usd', 1)} else 0.0 end
      as credit_utilization_pct,
    case when max_overdue_days > 60 then '🔴 Riesgo Alto / Moroso' when max_overdue_days > 0 then '🟡 Vencido Moderado'
         else '🟢 Al Día' end as risk_status
  from ar_dir)
"""


def _inv(spark, sf_dir):
    return mart_for(spark, sf_dir).inventory_items


# ------------------------------------------------------------------ V15–V18
@register("inventory_items", with_prelude(FACT_USD, SVC_INV, final="select * from inventory_items"))
def q_inventory_items(spark, sf_dir):
    """Service item metrics (USD cost, valuation, turnover, DIO, health)."""
    return _inv(spark, sf_dir)


@register("item_cogs_12m", with_prelude(FACT_USD, SVC_INV, final="select * from cogs12"))
def q_item_cogs_12m(spark, sf_dir):
    """Trailing-12-month units and COGS per item."""
    return mart_for(spark, sf_dir).item_cogs_12m


@register("inventory_kpis", with_prelude(FACT_USD, SVC_INV, final=f"""
select total_valuation_usd, annual_cogs_usd, total_units_on_hand, total_units_on_order, inventory_turnover,
  case when inventory_turnover > 0 then {R('365.0 / inventory_turnover', 1)} else 0.0 end as days_inventory_outstanding,
  stockout_items_count, at_risk_items_count, optimal_items_count, excess_items_count, total_items_catalog,
  (select r from svc_fx) as exchange_rate_applied, 'ALL' as sku_type_filter
from inv_kpis2"""))
def q_inventory_kpis(spark, sf_dir):
    """Inventory KPIs."""
    m = mart_for(spark, sf_dir)
    return I.inventory_kpis(m.inventory_items, m.latest_rate)


@register("inventory_by_category", with_prelude(FACT_USD, SVC_INV, final=f"""
select *, case when total_valuation_usd > 0 then {R('annual_cogs_usd / total_valuation_usd', 2)} else 0.0 end as turnover
from (select category, cast(round(sum(cast(total_valuation_usd as decimal(30,2))), 2) as double) as total_valuation_usd,
        cast(round(sum(cast(annual_cogs_usd as decimal(30,2))), 2) as double) as annual_cogs_usd,
        count(item_number) as items_count, {MS('qty_on_hand', 4)} as qty_on_hand
      from inventory_items group by 1)
order by total_valuation_usd desc, category"""))
def q_inventory_by_category(spark, sf_dir):
    """Inventory by category."""
    return I.inventory_by_category(_inv(spark, sf_dir))


@register("inventory_by_location", with_prelude(FACT_USD, SVC_INV, final=f"""
select * from (
  select location_code, {MS('valuation_usd')} as total_valuation_usd, {MS('qty_on_hand', 4)} as total_qty_on_hand,
    count(distinct item_number) as items_count
  from (select *, {R('qty_on_hand * (unit_cost_vef / (select r from svc_fx))', 2)} as valuation_usd
        from svc_stock where record_type = 2)
  group by 1)
where total_valuation_usd > 0 order by total_valuation_usd desc, location_code"""))
def q_inventory_by_location(spark, sf_dir):
    """Inventory by warehouse."""
    m = mart_for(spark, sf_dir)
    return I.inventory_by_location(m.service_stock, m.latest_rate)


@register("inventory_health_summary", with_prelude(FACT_USD, SVC_INV, final="""
select health_status, count(item_number) as items_count,
  cast(round(sum(cast(total_valuation_usd as decimal(30,2))), 2) as double) as valuation_usd
from inventory_items group by 1"""))
def q_inventory_health_summary(spark, sf_dir):
    """Item count and valuation per health label."""
    return I.inventory_health_summary(_inv(spark, sf_dir))


@register("inventory_directory", with_prelude(FACT_USD, SVC_INV, final="""
select * from inventory_items where sku_type = 'PT' order by total_valuation_usd desc, item_number"""))
def q_inventory_directory(spark, sf_dir):
    """Item directory filtered to finished goods, most valuable first."""
    return I.inventory_directory(_inv(spark, sf_dir), sku="PT")


# ------------------------------------------------------------------ V19–V25
@register("ar_documents", with_prelude(FACT_USD, SVC_INV, SVC_AR, final="select * from ar_docs"))
def q_ar_documents(spark, sf_dir):
    """V19 + V20: open documents with USD balances and aging."""
    return mart_for(spark, sf_dir).ar_documents


@register("ar_kpis", with_prelude(FACT_USD, SVC_INV, SVC_AR, final=f"""
select total_ar_balance_usd, total_overdue_usd, total_current_usd,
  case when total_ar_balance_usd > 0 then {R('total_overdue_usd * 100 / total_ar_balance_usd', 2)} else 0.0 end
    as delinquency_rate_pct,
  case when (select s from s90) > 0 then {R('total_ar_balance_usd / (select s from s90) * 90', 1)} else 0.0 end
    as dso_days,
  customers_with_debt_count, open_documents_count, (select s from s90) as sales_90d_usd,
  (select r from svc_fx) as exchange_rate_applied
from ar_kpis"""))
def q_ar_kpis(spark, sf_dir):
    """Receivables KPIs with DSO."""
    m = mart_for(spark, sf_dir)
    return AR.ar_kpis(m.ar_documents, m.sales_90d_usd, m.latest_rate)


@register("ar_aging_summary", with_prelude(FACT_USD, SVC_INV, SVC_AR, final="""
select aging_bucket, count(doc_number) as docs_count,
  cast(round(sum(cast(balance_usd as decimal(30,2))), 2) as double) as total_balance_usd
from ar_docs group by 1
order by case aging_bucket when 'Corriente / Al Día' then 0 when 'Vencido 1-30 Días' then 1
  when 'Vencido 31-60 Días' then 2 when 'Vencido 61-90 Días' then 3 when 'Vencido >90 Días' then 4 else 99 end"""))
def q_ar_aging_summary(spark, sf_dir):
    """Aging buckets in order."""
    return AR.ar_aging_summary(mart_for(spark, sf_dir).ar_documents)


def _breakdown_oracle(key: str, extra_where: str = "") -> str:
    return f"""
select *, case when total_ar_usd > 0 then {R('overdue_usd * 100 / total_ar_usd', 1)} else 0.0 end as delinquency_pct
from (select {key}, cast(round(sum(cast(balance_usd as decimal(30,2))), 2) as double) as total_ar_usd,
        cast(round(coalesce(sum(case when overdue_days > 0 then cast(balance_usd as decimal(30,2)) end), 0), 2)
             as double) as overdue_usd,
        count(distinct customer_id) as customers_count, count(doc_number) as docs_count
      from ar_docs group by 1)
{extra_where}
order by total_ar_usd desc, {key}"""


@register("ar_by_territory", with_prelude(FACT_USD, SVC_INV, SVC_AR, final=_breakdown_oracle("territory_name")))
def q_ar_by_territory(spark, sf_dir):
    """Receivables by territory."""
    return AR.ar_by_territory(mart_for(spark, sf_dir).ar_documents)


@register("ar_by_salesperson", with_prelude(FACT_USD, SVC_INV, SVC_AR, final=_breakdown_oracle(
    "salesperson_name", "where salesperson_name <> 'No Asignado'")))
def q_ar_by_salesperson(spark, sf_dir):
    """Receivables by salesperson."""
    return AR.ar_by_salesperson(mart_for(spark, sf_dir).ar_documents)


@register("top_ar_salespeople", with_prelude(FACT_USD, SVC_INV, SVC_AR, final=_breakdown_oracle(
    "salesperson_name", "where salesperson_name <> 'No Asignado'") + " limit 8"))
def q_top_ar_salespeople(spark, sf_dir):
    """Top-8 salespeople by receivables (chart feed)."""
    return AR.ar_by_salesperson(mart_for(spark, sf_dir).ar_documents).limit(8)


@register("ar_customer_directory", with_prelude(FACT_USD, SVC_INV, SVC_AR, final="""
select * from ar_directory order by total_debt_usd desc, customer_id, customer_name, customer_class_id,
  territory_name, salesperson_name"""))
def q_ar_customer_directory(spark, sf_dir):
    """V24 + K08: receivables directory with credit utilisation and risk."""
    return AR.ar_customer_directory(mart_for(spark, sf_dir).ar_documents)


@register("ar_customer_documents", with_prelude(FACT_USD, SVC_INV, SVC_AR, final="""
select * from ar_docs order by customer_id, due_date nulls last, doc_number, doc_type"""))
def q_ar_customer_documents(spark, sf_dir):
    """V25 (bulk form): every customer's open documents by due date."""
    return AR.ar_customer_documents(mart_for(spark, sf_dir).ar_documents)


# ----------------------------------------------------------------------- K07
@register("kpi_bands", with_prelude(FACT_USD, SVC_INV, SVC_AR, final=f"""
, k as (
  select case when (select s from s90) > 0 then {R('total_ar_balance_usd / (select s from s90) * 90', 1)} else 0.0 end
      as dso_days,
    (select inventory_turnover from inv_kpis2) as inventory_turnover
  from ar_kpis)
select dso_days,
  case when dso_days < 45 then 'Nivel Excelente' when dso_days <= 60 then 'Nivel Normal / Aceptable'
       else 'Alerta de Iliquidez' end as dso_band,
  inventory_turnover,
  case when inventory_turnover > 6 then 'Alta rotación' when inventory_turnover >= 2 then 'Rotación estándar'
       else 'Baja rotación' end as turnover_band
from k"""))
def q_kpi_bands(spark, sf_dir):
    """DSO and turnover bands."""
    m = mart_for(spark, sf_dir)
    ar = AR.ar_kpis(m.ar_documents, m.sales_90d_usd, m.latest_rate)
    inv = I.inventory_kpis(m.inventory_items, m.latest_rate)
    turn = inv.select("inventory_turnover").scalar()
    return ar.select("dso_days", I.dso_band(F.col("dso_days")).alias("dso_band"),
                     turn.alias("inventory_turnover"), I.turnover_band(turn).alias("turnover_band"))


# ------------------------------------------------------------ V13, V14, V26
@register("filter_facets", with_prelude(FACT_USD, SVC_INV, final="""
select facet, value from (
  select distinct 'territory' as facet, territory_name as value from fact_usd
    where territory_name is not null and territory_name <> '' and territory_name not in ('INACTIVO', 'Sin Zona')
  union select distinct 'customer_class', customer_class_id from fact_usd
    where customer_class_id is not null and customer_class_id <> ''
  union select distinct 'salesperson', salesperson_name from fact_usd
    where salesperson_name is not null and salesperson_name <> '' and salesperson_name <> 'No Asignado'
      and not contains(salesperson_name, 'INACTIVO')
  union select distinct 'inventory_category', category from inventory_items where category is not null and category <> ''
  union all select 'min_date', strftime(min(document_date), '%Y-%m-%d') from fact_usd
  union all select 'max_date', strftime(max(document_date), '%Y-%m-%d') from fact_usd)
order by facet, value"""))
def q_filter_facets(spark, sf_dir):
    """Filter options and date range."""
    m = mart_for(spark, sf_dir)
    return D.filter_facets(m.fact_usd, m.inventory_items)


@register("salespeople_by_territory", with_prelude(FACT_USD, final="""
select distinct territory_name, salesperson_name from fact_usd
where territory_name is not null and salesperson_name is not null
  and salesperson_name <> 'No Asignado' and not contains(salesperson_name, 'INACTIVO')
order by 1, 2"""))
def q_salespeople_by_territory(spark, sf_dir):
    """V14 (flat pairs; the list-per-territory form is ``salespeople_by_territory``)."""
    return D.salespeople_by_territory_pairs(mart_for(spark, sf_dir).fact_usd)


SEARCH_CUSTOMERS = "nation_2"
SEARCH_ITEMS = ("widget", "Sobreinventario")
SEARCH_AR = ("nation_1", "OVERDUE")


@register("search_customers", with_prelude(FACT_USD, RFM_METRICS, final=f"""
select * from rfm_metrics
where coalesce(contains(lower(customer_id), '{SEARCH_CUSTOMERS}'), false)
   or coalesce(contains(lower(customer_name), '{SEARCH_CUSTOMERS}'), false)
   or coalesce(contains(lower(territory_name), '{SEARCH_CUSTOMERS}'), false)
   or coalesce(contains(lower(customer_class_id), '{SEARCH_CUSTOMERS}'), false)"""))
def q_search_customers(spark, sf_dir):
    """Customer directory search."""
    m = mart_for(spark, sf_dir)
    return D.search_customers(rfm.customer_rfm_metrics(m.fact_usd, m.as_of), SEARCH_CUSTOMERS)


@register("search_inventory", with_prelude(FACT_USD, SVC_INV, final=f"""
select * from inventory_items
where (coalesce(contains(lower(item_number), '{SEARCH_ITEMS[0]}'), false)
    or coalesce(contains(lower(item_description), '{SEARCH_ITEMS[0]}'), false)
    or coalesce(contains(lower(category), '{SEARCH_ITEMS[0]}'), false)
    or coalesce(contains(lower(sku_type), '{SEARCH_ITEMS[0]}'), false))
  and health_status = '{SEARCH_ITEMS[1]}'"""))
def q_search_inventory(spark, sf_dir):
    """Inventory search with a health filter."""
    return D.search_inventory(_inv(spark, sf_dir), *SEARCH_ITEMS)


@register("search_receivables", with_prelude(FACT_USD, SVC_INV, SVC_AR, final=f"""
select * from ar_directory
where (coalesce(contains(lower(customer_id), '{SEARCH_AR[0]}'), false)
    or coalesce(contains(lower(customer_name), '{SEARCH_AR[0]}'), false)
    or coalesce(contains(lower(territory_name), '{SEARCH_AR[0]}'), false)
    or coalesce(contains(lower(salesperson_name), '{SEARCH_AR[0]}'), false))
  and coalesce(overdue_debt_usd, 0) > 0"""))
def q_search_receivables(spark, sf_dir):
    """Receivables directory search with the OVERDUE filter."""
    return D.search_receivables(AR.ar_customer_directory(mart_for(spark, sf_dir).ar_documents), *SEARCH_AR)


# ------------------------------------------------------------------ S06–S08
@register("export_customers", with_prelude(FACT_USD, RFM_METRICS, final="""
select customer_id as Codigo_Cliente, customer_name as Nombre_Cliente, customer_class_id as Clase,
  territory_name as Zona, segment as Segmento_RFM, total_orders as Total_Pedidos, total_net_sales as Ventas_USD,
  customer_ltv_gross_profit as LTV_USD, recency_days as Recencia_Dias
from rfm_segments"""))
def q_export_customers(spark, sf_dir):
    """customer/RFM export rows."""
    m = mart_for(spark, sf_dir)
    return D.export_customers(rfm.rfm_median_segments(rfm.customer_rfm_metrics(m.fact_usd, m.as_of)))


@register("export_inventory", with_prelude(FACT_USD, SVC_INV, final="""
select item_number as Codigo_Articulo, item_description as Descripcion, sku_type as Tipo_SKU, category as Categoria,
  qty_on_hand as Stock_Fisico, qty_allocated as Comprometido, qty_available as Disponible, qty_on_order as En_Transito,
  unit_cost_usd as Costo_Unitario_USD, total_valuation_usd as Valoracion_USD, inventory_turnover as Rotacion_Turnover,
  dio as DIO_Dias, health_status as Estado_Salud
from inventory_items"""))
def q_export_inventory(spark, sf_dir):
    """Inventory export rows."""
    return D.export_inventory(_inv(spark, sf_dir))


@register("export_receivables", with_prelude(FACT_USD, SVC_INV, SVC_AR, final="""
select customer_id as Codigo_Cliente, customer_name as Nombre_Cliente, territory_name as Zona,
  salesperson_name as Vendedor, total_debt_usd as Saldo_Total_USD, current_debt_usd as Saldo_Al_Dia_USD,
  overdue_debt_usd as Saldo_Vencido_USD, credit_limit_usd as Limite_Credito_USD,
  credit_utilization_pct as Utilizacion_Pct, max_overdue_days as Max_Atraso_Dias, risk_status as Estado_Riesgo,
  docs_count as Total_Documentos
from ar_directory"""))
def q_export_receivables(spark, sf_dir):
    """Receivables export rows."""
    return D.export_receivables(AR.ar_customer_directory(mart_for(spark, sf_dir).ar_documents))
