"""Sales queries: M01, M03, M04, M06, V01–V05, V27, V28, K06."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..mart import mart_for
from ..operators import cube, fx, org, sales
from ..functions.numeric import rnd
from .oracle_base import AS_OF_SQL, dbl, with_prelude
from .oracle_common import ENRICHED, FACT_USD
from .registry import register


def R(expr: str, n: int) -> str:
    """Oracle form of ``functions.numeric.rnd``."""
    return f"cast(round(cast({expr} as decimal(28,8)), {n}) as double)"


def MS(col: str, scale: int = 2) -> str:
    """Oracle form of ``sales.money_sum`` (exact sum, reported as double)."""
    return f"cast(sum(cast({col} as decimal(30,{scale}))) as double)"


# ---------------------------------------------------------------- M06
@register("sales_lines_enriched", with_prelude(ENRICHED, final=f"""
select {dbl('direction_multiplier', 'net_quantity', 'unit_price', 'gross_sales_amount', 'unit_cost',
            'total_cost_amount', 'markdown_amount', 'net_sales_amount', 'gross_profit_amount')}
from enriched"""))
def q_sales_lines_enriched(spark, sf_dir):
    """M06 over all sales lines."""
    return mart_for(spark, sf_dir).sales_lines_enriched


# ---------------------------------------------------------------- M01
@register("fx_asof_sales", with_prelude(FACT_USD, final="""
select h.SOPTYPE as sop_type, trim(h.SOPNUMBE) as invoice_number, cast(h.DOCDATE as date) as document_date,
  f.exch_date, f.xchg_rate,
  case when cast(h.XCHGRATE as double) > 0 then cast(h.XCHGRATE as double)
       when f.xchg_rate > 0 then f.xchg_rate else 1.0 end as effective_rate
from SOP30200 h asof left join fx_rates f on cast(h.DOCDATE as date) >= f.exch_date"""))
def q_fx_asof_sales(spark, sf_dir):
    """M01 + M02: as-of (backward) rate and effective rate of every sales document."""
    m = mart_for(spark, sf_dir)
    h = m.src["SOP30200"].select(
        F.col("SOPTYPE").alias("sop_type"), F.trim("SOPNUMBE").alias("invoice_number"),
        F.col("DOCDATE").cast("date").alias("document_date"), F.col("XCHGRATE").cast("double").alias("header_rate"))
    j = fx.asof_join(h, m.rates, "document_date")
    return j.select("sop_type", "invoice_number", "document_date", "exch_date", "xchg_rate",
                    fx.effective_rate(F.col("header_rate"), F.col("xchg_rate")).alias("effective_rate"))


# ---------------------------------------------------------------- M03
FACT_USD_COLS = ("sop_type, invoice_number, line_item_sequence, document_date, gl_post_date, customer_id, customer_name, "
                 "customer_class_id, salesperson_name, salesperson_id, territory_name, territory_id, item_number, "
                 "item_description, category, currency_id, header_rate, quantity, unit_price_vef, "
                 "extended_price_vef, orig_extended_price, unit_cost_vef, extended_cost_vef, markdown_vef, "
                 "exch_date, xchg_rate, effective_rate, direction_multiplier, doc_type_desc, net_sales_amount, "
                 "extended_cost_usd, gross_profit_amount, year_month")


@register("fact_sales_usd", with_prelude(FACT_USD, final=f"select {FACT_USD_COLS} from fact_usd"))
def q_fact_sales_usd(spark, sf_dir):
    """Service USD sales lines of the trailing 36 months."""
    return mart_for(spark, sf_dir).fact_usd.select(*[c.strip() for c in FACT_USD_COLS.split(",")])


# ---------------------------------------------------------------- M04
@register("resolve_sales_org", with_prelude(FACT_USD, final="""
select sop_type, invoice_number, customer_class_id, salesperson_name, salesperson_id, territory_name, territory_id
from doc_org"""))
def q_resolve_sales_org(spark, sf_dir):
    """salesperson/territory fallback chain for every sales document."""
    m = mart_for(spark, sf_dir)
    s = m.src
    h = s["SOP30200"].select("SOPTYPE", "SOPNUMBE", "CUSTNMBR", "SLPRSNID", "SALSTERR")
    r = org.resolve_sales_org(h, s["RM00101"], s["RM00301"], s["RM00303"])
    return r.select(F.col("SOPTYPE").alias("sop_type"), F.trim("SOPNUMBE").alias("invoice_number"),
                    "customer_class_id", "salesperson_name", "salesperson_id", "territory_name", "territory_id")


# ---------------------------------------------------------------- V01
FILTER_EXAMPLE = dict(territory="NATION_3", customer_class="ALL", salesperson=None,
                      start_date="2000-01-01", end_date="2000-12-31")


@register("sales_filtered", with_prelude(FACT_USD, final="""
select invoice_number, line_item_sequence, document_date, customer_id, territory_name, customer_class_id,
  salesperson_name, net_sales_amount, gross_profit_amount
from fact_usd
where territory_name = 'NATION_3' and document_date >= DATE '2000-01-01' and document_date <= DATE '2000-12-31'"""))
def q_sales_filtered(spark, sf_dir):
    """The service filters (territory + inclusive date range)."""
    f = sales.apply_filters(mart_for(spark, sf_dir).fact_usd, **FILTER_EXAMPLE)
    return f.select("invoice_number", "line_item_sequence", "document_date", "customer_id", "territory_name",
                    "customer_class_id", "salesperson_name", "net_sales_amount", "gross_profit_amount")


# ---------------------------------------------------------------- V02
@register("kpi_summary", with_prelude(FACT_USD, final=f"""
, last_p as (select customer_id, max(document_date) as lp from fact_usd where customer_id is not null group by 1),
act as (select count(*) filter (where lp >= {AS_OF_SQL} - 90) as active_customers,
               count(*) filter (where lp < {AS_OF_SQL} - 90) as churned_customers from last_p),
tot as (select {MS('net_sales_amount')} as total_net_sales, {MS('gross_profit_amount')} as total_gross_profit,
               count(distinct invoice_number) as total_orders, {MS('quantity', 4)} as total_units from fact_usd),
scope as (select count(*) as total_customers_in_scope from RM00101)
select total_net_sales, total_gross_profit,
  case when total_net_sales > 0 then {R('total_gross_profit * 100 / total_net_sales', 2)} else 0.0 end as gross_margin_pct,
  total_orders, total_units,
  case when total_orders > 0 then {R('total_net_sales / total_orders', 2)} else 0.0 end as average_order_value,
  active_customers, churned_customers,
  case when active_customers + churned_customers > 0
    then {R('churned_customers * 100 / (active_customers + churned_customers)', 2)} else 0.0 end as churn_rate_pct,
  case when active_customers + churned_customers > 0
    then {R('total_gross_profit / (active_customers + churned_customers)', 2)} else 0.0 end as average_ltv_gross_profit,
  total_customers_in_scope, total_net_sales as net_sales, total_gross_profit as gross_profit,
  churned_customers as churned_customers_count,
  case when active_customers + churned_customers > 0
    then {R('total_gross_profit / (active_customers + churned_customers)', 2)} else 0.0 end as average_customer_ltv
from tot, act, scope"""))
def q_kpi_summary(spark, sf_dir):
    """KPI summary of the whole 36-month fact."""
    m = mart_for(spark, sf_dir)
    return sales.kpi_summary(m.fact_usd, m.service_customers, m.as_of)


# ---------------------------------------------------------------- V03–V05
@register("sales_trend", with_prelude(FACT_USD, final=f"""
select year_month, net_sales, gross_profit, orders_count,
  case when net_sales > 0 then {R('gross_profit * 100 / net_sales', 2)} else 0.0 end as gross_margin_pct,
  year_month as month, net_sales as sales
from (select year_month, cast(round(sum(cast(net_sales_amount as decimal(30,2))), 2) as double) as net_sales,
        cast(round(sum(cast(gross_profit_amount as decimal(30,2))), 2) as double) as gross_profit,
        count(distinct invoice_number) as orders_count
      from fact_usd group by 1)"""))
def q_sales_trend(spark, sf_dir):
    """Monthly trend."""
    return sales.sales_trend(mart_for(spark, sf_dir).fact_usd)


@register("sales_by_territory", with_prelude(FACT_USD, final=f"""
select territory_name, {MS('net_sales_amount')} as net_sales, {MS('gross_profit_amount')} as gross_profit,
  count(distinct invoice_number) as orders_count, {MS('net_sales_amount')} as sales
from fact_usd group by 1 order by net_sales desc, territory_name"""))
def q_sales_by_territory(spark, sf_dir):
    """Sales by territory."""
    return sales.sales_by_territory(mart_for(spark, sf_dir).fact_usd)


@register("sales_by_category", with_prelude(FACT_USD, final=f"""
select category, {MS('net_sales_amount')} as net_sales, {MS('quantity', 4)} as units_sold, category as category_id,
  {MS('net_sales_amount')} as sales
from fact_usd group by 1 order by net_sales desc, category"""))
def q_sales_by_category(spark, sf_dir):
    """Sales by item category."""
    return sales.sales_by_category(mart_for(spark, sf_dir).fact_usd)


# ---------------------------------------------------------------- V27 / V28
@register("top_categories", with_prelude(FACT_USD, final=f"""
select category, {MS('net_sales_amount')} as net_sales, {MS('quantity', 4)} as units_sold, category as category_id,
  {MS('net_sales_amount')} as sales
from fact_usd group by 1 order by net_sales desc, category limit 10"""))
def q_top_categories(spark, sf_dir):
    """Top-10 categories chart feed (top-k is the feature)."""
    return sales.sales_by_category(mart_for(spark, sf_dir).fact_usd).limit(10)


@register("territory_share", with_prelude(FACT_USD, final=f"""
, g as (select territory_name, sum(cast(net_sales_amount as decimal(30,2))) as net_sales from fact_usd group by 1)
select territory_name, cast(net_sales as double) as net_sales,
  {R('cast(net_sales as double) * 100 / (select cast(sum(net_sales) as double) from g)', 1)} as share_pct
from g"""))
def q_territory_share(spark, sf_dir):
    """Share of total net sales per territory (donut percentage)."""
    g = sales.sales_by_territory(mart_for(spark, sf_dir).fact_usd).select("territory_name", "net_sales")
    total = g.select(F.sum("net_sales")).scalar()
    return g.select("territory_name", "net_sales", rnd(F.col("net_sales") * 100 / total, 1).alias("share_pct"))


# ---------------------------------------------------------------- K06
@register("sales_slice_quarter", with_prelude(FACT_USD, final=f"""
select cast(date_trunc('quarter', document_date) as date) as period_start, territory_name,
  {MS('net_sales_amount')} as net_sales, {MS('gross_profit_amount')} as gross_profit,
  count(distinct invoice_number) as orders_count, {MS('quantity', 4)} as units,
  count(distinct customer_id) as customers_count
from fact_usd group by 1, 2"""))
def q_sales_slice_quarter(spark, sf_dir):
    """Quarter × territory slice."""
    return sales.sales_slice(mart_for(spark, sf_dir).fact_usd, "quarter", ("territory_name",))


@register("sales_slice_week", with_prelude(FACT_USD, final=f"""
select cast(date_trunc('week', document_date) as date) as period_start, category, customer_class_id,
  {MS('net_sales_amount')} as net_sales, {MS('gross_profit_amount')} as gross_profit,
  count(distinct invoice_number) as orders_count, {MS('quantity', 4)} as units,
  count(distinct customer_id) as customers_count
from fact_usd group by 1, 2, 3"""))
def q_sales_slice_week(spark, sf_dir):
    """Week × category × class slice."""
    return sales.sales_slice(mart_for(spark, sf_dir).fact_usd, "week", ("category", "customer_class_id"))


@register("sales_slice_posting", with_prelude(FACT_USD, final=f"""
, first_sale as (select customer_id, min(document_date) as d0 from fact_usd group by 1),
cut as (select f.*, datediff('month', d0, f.document_date) as cohort_age_months,
          case when c.CRLMTAMT is null and not exists (select 1 from RM00101 x where rtrim(x.CUSTNMBR) = f.customer_id) then null
               when coalesce(c.CRLMTAMT, 0) > 100000 then '> 100000' when coalesce(c.CRLMTAMT, 0) > 25000 then '25000-100000'
               when coalesce(c.CRLMTAMT, 0) > 0 then '0-25000' else '<= 0' end as credit_limit_band
        from fact_usd f left join first_sale using (customer_id) left join RM00101 c on rtrim(c.CUSTNMBR) = f.customer_id)
select cast(date_trunc('month', gl_post_date) as date) as period_start, credit_limit_band,
  cast(cohort_age_months as integer) as cohort_age_months,
  {MS('net_sales_amount')} as net_sales, {MS('gross_profit_amount')} as gross_profit,
  count(distinct invoice_number) as orders_count, {MS('quantity', 4)} as units,
  count(distinct customer_id) as customers_count
from cut group by 1, 2, 3"""))
def q_sales_slice_posting(spark, sf_dir):
    """Posting month × credit-limit band × cohort age."""
    m = mart_for(spark, sf_dir)
    fact = sales.with_customer_cuts(m.fact_usd, m.stg_customers)
    return sales.sales_slice(fact, "month", ("credit_limit_band", "cohort_age_months"), "gl_post_date")


# The cuts as in sales_slice_posting; every slice counts its own documents and customers.
_CUT_CTES = """
, first_sale as (select customer_id, min(document_date) as d0 from fact_usd group by 1),
aged as (select f.*, datediff('month', d0, f.document_date) as age,
           case when c.CRLMTAMT is null and not exists (select 1 from RM00101 x where rtrim(x.CUSTNMBR) = f.customer_id) then null
                when coalesce(c.CRLMTAMT, 0) > 100000 then '> 100000' when coalesce(c.CRLMTAMT, 0) > 25000 then '25000-100000'
                when coalesce(c.CRLMTAMT, 0) > 0 then '0-25000' else '<= 0' end as credit_limit_band
         from fact_usd f left join first_sale using (customer_id) left join RM00101 c on rtrim(c.CUSTNMBR) = f.customer_id),
cut as (select *, 'all' as everything, case when age >= 12 then '12+' when age >= 6 then '6-11' when age >= 3 then '3-5'
                when age >= 0 then '0-2' end as cohort_age_band from aged)"""


def _slices_sql() -> str:
    parts = [f"""
select '{grain}' as grain, cast(date_trunc('{grain}', document_date) as date) as period_start, '{name}' as cut,
  {column} as cut_value, {MS('net_sales_amount')} as net_sales, {MS('gross_profit_amount')} as gross_profit,
  count(distinct invoice_number) as orders_count, {MS('quantity', 4)} as units,
  count(distinct customer_id) as customers_count from cut group by all"""
             for grain in cube.GRAINS for name, column in [(cube.EVERYTHING, "everything"), *[(c, c) for c in cube.CUTS]]]
    return _CUT_CTES + "\nunion all ".join(parts)


@register("sales_slice_cube", with_prelude(FACT_USD, final=_slices_sql()))
def q_sales_slice_cube(spark, sf_dir):
    """Every grain x cut out of one cube, customers rolled up as bitmaps."""
    m = mart_for(spark, sf_dir)
    fact = sales.with_customer_cuts(m.fact_usd, m.stg_customers)
    fact = fact.withColumn("cohort_age_band", cube.age_band(F.col("cohort_age_months")))
    return cube.all_slices(cube.slice_cube(fact))
