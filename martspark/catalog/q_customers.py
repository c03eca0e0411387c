"""Customer queries: M07–M09, A01, A02, K01–K05, V06–V12, V29."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..mart import mart_for
from ..operators import customers as C
from ..operators import rfm
from .oracle_base import AS_OF_SQL, dbl, with_prelude
from .oracle_common import (CUSTOMER_MONTHLY, CUSTOMER_MONTHLY_DENSE, CUSTOMER_SUMMARY, ENRICHED, FACT_USD,
                            SVC_CUSTOMERS)
from .q_sales import MS, R
from .registry import register

SUMMARY_DECIMALS = ("credit_limit_amount", "total_gross_revenue", "total_returns_amount", "total_net_revenue",
                    "total_cogs", "historical_ltv_gross_profit", "total_units_purchased")
MONTHLY_DECIMALS = ("gross_sales_month", "returns_amount_month", "net_sales_month", "total_cogs_month",
                    "gross_profit_month", "cumulative_net_sales_ltv", "cumulative_gross_profit_ltv")


# ------------------------------------------------------------------ M07–M09
@register("customer_orders_summary", with_prelude(ENRICHED, CUSTOMER_SUMMARY,
                                                  final=f"select {dbl(*SUMMARY_DECIMALS)} from summary"))
def q_customer_orders_summary(spark, sf_dir):
    """Lifetime totals and churn status per customer."""
    m = mart_for(spark, sf_dir)
    return C.customer_orders_summary(m.sales_lines_enriched, m.stg_customers, m.as_of)


@register("customer_monthly", with_prelude(ENRICHED, CUSTOMER_MONTHLY,
                                           final=f"select {dbl(*MONTHLY_DECIMALS)} from customer_monthly"))
def q_customer_monthly(spark, sf_dir):
    """Customer × month with sales lines, running LTV."""
    return C.customer_monthly(mart_for(spark, sf_dir).sales_lines_enriched)


@register("customer_monthly_dense", with_prelude(
    ENRICHED, CUSTOMER_MONTHLY, CUSTOMER_MONTHLY_DENSE,
    final=f"select {dbl(*MONTHLY_DECIMALS)} from customer_monthly_dense"))
def q_customer_monthly_dense(spark, sf_dir):
    """Customer × every month from cohort to as-of month."""
    m = mart_for(spark, sf_dir)
    return C.customer_monthly_dense(m.sales_lines_enriched, m.as_of)


# ----------------------------------------------------------------------- A01
def _cohort_oracle(src: str) -> str:
    return f"""
select cohort_month, month_number, total_customers_in_cohort, active_customers,
  {R('cast(active_customers * 100 as double) / nullif(cast(total_customers_in_cohort as double), 0)', 2)}
    as retention_rate_pct,
  {R('100.0 - cast(active_customers * 100 as double) / nullif(cast(total_customers_in_cohort as double), 0)', 2)}
    as churn_rate_pct,
  cast(total_cohort_net_sales as double) as total_cohort_net_sales, average_ltv_gross_profit
from (
  select cast(date_trunc('month', first_purchase_date) as date) as cohort_month,
    cast((year(period_month) * 12 + month(period_month))
         - (year(cohort_month) * 12 + month(cohort_month)) as integer) as month_number,
    count(distinct customer_id) as total_customers_in_cohort,
    cast(sum(active_month_flag) as bigint) as active_customers,
    sum(net_sales_month) as total_cohort_net_sales,
    {R('cast(sum(cumulative_gross_profit_ltv) as double) / count(cumulative_gross_profit_ltv)', 6)}
      as average_ltv_gross_profit
  from {src} group by 1, 2)
order by cohort_month, month_number"""


@register("cohort_retention", with_prelude(ENRICHED, CUSTOMER_MONTHLY, final=_cohort_oracle("customer_monthly")))
def q_cohort_retention(spark, sf_dir):
    """A01 on M08 (cell denominators)."""
    return C.cohort_retention(C.customer_monthly(mart_for(spark, sf_dir).sales_lines_enriched))


@register("cohort_retention_dense", with_prelude(ENRICHED, CUSTOMER_MONTHLY, CUSTOMER_MONTHLY_DENSE,
                                                 final=_cohort_oracle("customer_monthly_dense")))
def q_cohort_retention_dense(spark, sf_dir):
    """A01 on M09 (cohort-size denominators)."""
    m = mart_for(spark, sf_dir)
    return C.cohort_retention(C.customer_monthly_dense(m.sales_lines_enriched, m.as_of))


# ----------------------------------------------------------------------- K01
@register("churn_rate_monthly", with_prelude(ENRICHED, final=f"""
, valid as (select customer_id, min(document_date) as first_d from stg_sales_headers
          where sop_type = 3 and is_voided = 0 group by 1),
people as (select c.customer_id from stg_customers c left join valid using (customer_id)
           where c.is_inactive = 0 or coalesce(first_d - cast(c.created_at as date) <= 15, false)),
buys as (select distinct e.customer_id, e.document_date as d from enriched e join people using (customer_id)
         where e.sop_type = 3),
span as (select customer_id, cast(date_trunc('month', min(d)) as date) as m0 from buys group by 1),
grid as (select customer_id, cast(unnest(generate_series(cast(m0 as timestamp),
           cast(date_trunc('month', {AS_OF_SQL}) as timestamp), interval 1 month)) as date) as m from span),
-- a customer is active in month m if an invoice lies between m - 90 days and the end of m
state as (select g.customer_id, g.m,
            exists (select 1 from buys b where b.customer_id = g.customer_id
                    and b.d between g.m - 90 and last_day(g.m)) as now_active,
            exists (select 1 from buys b where b.customer_id = g.customer_id
                    and b.d between cast(g.m - interval 1 month as date) - 90 and g.m - 1) as was_active
          from grid g)
select m as period_month, count(*) filter (was_active) as active_start_month,
  count(*) filter (was_active and not now_active) as churned_customers,
  {R('cast(count(*) filter (was_active and not now_active) * 100 as double)'
     ' / nullif(cast(count(*) filter (was_active) as double), 0)', 2)} as churn_rate_pct
from state group by 1"""))
def q_churn_rate_monthly(spark, sf_dir):
    """Monthly churn rate (invoices of the churn base)."""
    m = mart_for(spark, sf_dir)
    return C.churn_rate_monthly(m.sales_lines_enriched, C.churn_base_customers(m.stg_customers, m.stg_sales_headers),
                                m.as_of)


# ----------------------------------------------------------------------- K02
@register("churn_base_customers", with_prelude(final="""
, fv as (select customer_id, min(document_date) as first_valid_purchase_date
        from stg_sales_headers where sop_type = 3 and is_voided = 0 group by 1)
select c.customer_id, c.customer_name, cast(c.created_at as date) as created_date, c.is_inactive,
  fv.first_valid_purchase_date
from stg_customers c left join fv on c.customer_id = fv.customer_id
where not (c.is_inactive = 1 and not coalesce(fv.first_valid_purchase_date <= cast(c.created_at as date) + 15, false))"""))
def q_churn_base_customers(spark, sf_dir):
    """Churn population after exclusions."""
    m = mart_for(spark, sf_dir)
    return C.churn_base_customers(m.stg_customers, m.stg_sales_headers)


# ------------------------------------------------------------------- K03–K05
_SEG = """
select {key}, count(*) as customers, sum(total_orders_count) as orders, sum(total_net_revenue) as net_revenue,
  sum(historical_ltv_gross_profit) as gross_profit,
  count(*) filter (where current_churn_status = 'Churned / Inactive') as churned
from summary where total_orders_count > 0 group by 1"""


@register("ltv_predictive", with_prelude(ENRICHED, CUSTOMER_SUMMARY, final=f"""
, seg as ({_SEG.format(key="cast(date_trunc('month', first_purchase_date) as date) as cohort_month")}),
v as (select cohort_month, customers,
        cast(net_revenue as double) / nullif(cast(customers as double), 0) as arpu,
        cast(gross_profit as double) / nullif(cast(net_revenue as double), 0) as margin,
        cast(churned as double) / nullif(cast(customers as double), 0) as churn
      from seg)
select cohort_month, customers, {R('arpu', 2)} as arpu, {R('margin * 100', 2)} as gross_margin_pct,
  {R('churn * 100', 2)} as churn_rate_pct, {R('arpu * margin / nullif(churn, 0.0)', 2)} as predictive_ltv
from v"""))
def q_ltv_predictive(spark, sf_dir):
    """Predictive LTV per cohort."""
    m = mart_for(spark, sf_dir)
    return C.ltv_predictive(C.customer_orders_summary(m.sales_lines_enriched, m.stg_customers, m.as_of))


@register("ltv_traditional", with_prelude(ENRICHED, CUSTOMER_SUMMARY, final=f"""
, seg as ({_SEG.format(key="coalesce(customer_class_id, 'UNKNOWN') as customer_class_id")}),
v as (select customer_class_id, customers,
        cast(net_revenue as double) / nullif(cast(orders as double), 0) as aov,
        cast(orders as double) / nullif(cast(customers as double), 0) as pf,
        1.0 / nullif(cast(churned as double) / nullif(cast(customers as double), 0), 0.0) as lifespan
      from seg)
select customer_class_id, customers, {R('aov', 2)} as average_order_value, {R('pf', 4)} as purchase_frequency,
  {R('lifespan', 4)} as customer_lifespan, {R('aov * pf * lifespan', 2)} as traditional_ltv
from v"""))
def q_ltv_traditional(spark, sf_dir):
    """AOV × frequency × lifespan per customer class."""
    m = mart_for(spark, sf_dir)
    return C.ltv_traditional(C.customer_orders_summary(m.sales_lines_enriched, m.stg_customers, m.as_of))


@register("ltv_historical", with_prelude(ENRICHED, CUSTOMER_SUMMARY, final=f"""
select customer_id, customer_name, customer_class_id, first_purchase_date, last_purchase_date,
  cast(datediff('day', first_purchase_date, last_purchase_date) as integer) as customer_tenure_days,
  total_orders_count, cast(total_gross_revenue as double) as total_gross_revenue,
  cast(total_returns_amount as double) as total_returns_amount, cast(total_net_revenue as double) as total_net_revenue,
  cast(total_cogs as double) as total_cogs, cast(total_net_revenue - total_cogs as double) as historical_ltv_gross_profit,
  {R('cast(total_net_revenue as double) / nullif(cast(total_orders_count as double), 0)', 2)} as average_order_value,
  {R('cast((total_net_revenue - total_cogs) * 100 as double) / nullif(cast(total_net_revenue as double), 0)', 2)}
    as gross_margin_pct
from summary"""))
def q_ltv_historical(spark, sf_dir):
    """Historical LTV and tenure per customer."""
    m = mart_for(spark, sf_dir)
    return C.ltv_historical(C.customer_orders_summary(m.sales_lines_enriched, m.stg_customers, m.as_of))


# ----------------------------------------------------------------------- V06
@register("churn_history", with_prelude(FACT_USD, final=f"""
, months as (select distinct cast(date_trunc('month', document_date) as date) as m from fact_usd),
t as (select m, m + 28 as target from months),
lp as (select t.m, s.customer_id, max(s.document_date) as last_d
       from t join (select distinct customer_id, document_date from fact_usd) s on s.document_date <= t.target
       group by 1, 2),
agg as (select t.m,
          count(lp.customer_id) filter (where lp.last_d >= t.target - 90) as active_customers,
          count(lp.customer_id) filter (where lp.last_d < t.target - 90) as churned_customers,
          count(lp.customer_id) as total
        from t left join lp on t.m = lp.m group by 1)
select strftime(m, '%Y-%m') as year_month, strftime(m, '%Y-%m') as period, active_customers, churned_customers,
  case when total > 0 then {R('cast(churned_customers * 100 as double) / cast(total as double)', 2)} else 0.0 end
    as churn_rate_pct
from agg order by 1"""))
def q_churn_history(spark, sf_dir):
    """Monthly churn history (bounded explode plan)."""
    return C.churn_history(mart_for(spark, sf_dir).fact_usd)


# ----------------------------------------------------------------------- V07
_PIV = ", ".join(f"max(case when period = {p} then n end) as p{p}" for p in range(6))
_MCOLS = ", ".join(
    f"case when s.total_users > 0 then {R(f'cast(coalesce(p.p{p}, 0) * 100 as double) / cast(s.total_users as double)', 1)}"
    f" else 0.0 end as m{p}" for p in range(6))


@register("cohort_matrix", with_prelude(FACT_USD, final=f"""
, cm as (select distinct customer_id, cast(date_trunc('month', document_date) as date) as m from fact_usd),
months as (select m, dense_rank() over (order by m) as idx from (select distinct m from cm)),
coh as (select customer_id, min(m) as cohort from cm group by 1),
recent as (select cohort from (select distinct cohort from coh) order by cohort desc limit 6),
mem as (select coh.* from coh join recent using (cohort)),
sizes as (select cohort, count(*) as total_users from mem group by 1),
act as (select mem.cohort, cm.customer_id, mi.idx - mc.idx as period
        from cm join mem using (customer_id) join months mi on mi.m = cm.m join months mc on mc.m = mem.cohort),
cells as (select cohort, period, count(distinct customer_id) as n from act where period between 0 and 5 group by 1, 2),
p as (select cohort, {_PIV} from cells group by 1)
select strftime(s.cohort, '%Y-%m') as cohort_month, s.total_users, s.total_users as new_customers, {_MCOLS}
from sizes s left join p on s.cohort = p.cohort order by 1"""))
def q_cohort_matrix(spark, sf_dir):
    """Last-6-cohort retention matrix (flat m0..m5)."""
    return C.cohort_matrix(mart_for(spark, sf_dir).fact_usd)


@register("cohort_matrix_periods", with_prelude(FACT_USD, final=f"""
, seen as (select distinct customer_id, strftime(document_date, '%Y-%m') as ym from fact_usd where customer_id is not null),
present as (select ym, row_number() over (order by ym) as k from (select distinct ym from seen)),
born as (select customer_id, min(ym) as c from seen group by 1),
sized as (select c, count(*) as total_users from born group by 1 order by c desc limit 6),
pairs as (select s.c, s.total_users, p.ym, p.k - b.k as n
          from sized s join present b on b.ym = s.c join present p on p.k between b.k and b.k + 5),
counted as (select pairs.*, (select count(*) from born join seen using (customer_id)
                             where born.c = pairs.c and seen.ym = pairs.ym) as users from pairs)
select c as cohort_month, any_value(total_users) as total_users,
  string_agg('M+' || n || ':' || users || ':' || {R('users * 100 / cast(total_users as double)', 1)}, ',' order by n) as periods
from counted group by c"""))
def q_cohort_matrix_periods(spark, sf_dir):
    """V07 nested form; the list of periods is shown as text."""
    d = C.cohort_matrix_periods(mart_for(spark, sf_dir).fact_usd)
    return d.select("cohort_month", "total_users", F.array_join(F.transform(
        "periods", lambda p: F.concat_ws(":", p["period"], p["active_users"].cast("string"),
                                         p["retention_pct"].cast("string"))), ",").alias("periods"))


# ------------------------------------------------------------------- V08–V12
RFM_METRICS = f"""
rfm_g as (
  select customer_id, customer_name, customer_class_id, territory_name, salesperson_name,
    max(document_date) as last_purchase, min(document_date) as first_purchase,
    count(distinct invoice_number) as frequency, {MS('net_sales_amount')} as monetary,
    {MS('gross_profit_amount')} as gross_profit_ltv
  from fact_usd
  where customer_id is not null and customer_name is not null and customer_class_id is not null
    and territory_name is not null and salesperson_name is not null
  group by 1, 2, 3, 4, 5),
rfm_metrics as (
  select *, cast(datediff('day', last_purchase, {AS_OF_SQL}) as integer) as recency_days,
    cast(datediff('day', first_purchase, {AS_OF_SQL}) as integer) as tenure_days,
    {R('monetary / nullif(cast(frequency as double), 0)', 2)} as average_order_value,
    frequency as total_orders, monetary as total_net_sales, gross_profit_ltv as customer_ltv_gross_profit
  from rfm_g),
rfm_med as (select median(frequency) as fm, median(monetary) as mm from rfm_metrics),
rfm_segments as (
  select r.*,
    case when recency_days <= 60 and frequency >= fm and monetary >= mm then 'Campeones / VIP'
         when recency_days <= 90 and frequency >= fm then 'Leales Potenciales'
         when recency_days <= 45 and frequency < fm then 'Prometedores / Recientes'
         when recency_days > 90 and monetary >= mm then 'En Riesgo'
         when recency_days > 90 then 'Inactivos / Perdidos'
         else 'Estándar' end as segment
  from rfm_metrics r, rfm_med),
rfm_summary as (
  select segment, count(customer_id) as customer_count,
    cast(round(sum(cast(monetary as decimal(30,2))), 2) as double) as total_revenue,
    {R('cast(sum(cast(gross_profit_ltv as decimal(30,2))) as double) / count(gross_profit_ltv)', 2)} as avg_ltv,
    {R('cast(sum(recency_days) as double) / count(recency_days)', 1)} as avg_recency
  from rfm_segments group by 1)
"""


@register("customer_rfm_metrics", with_prelude(FACT_USD, RFM_METRICS, final="select * from rfm_metrics"))
def q_customer_rfm_metrics(spark, sf_dir):
    """RFM metrics per service customer row."""
    m = mart_for(spark, sf_dir)
    return rfm.customer_rfm_metrics(m.fact_usd, m.as_of)


@register("rfm_median_segments", with_prelude(FACT_USD, RFM_METRICS,
                                              final="select *, segment as rfm_segment from rfm_segments"))
def q_rfm_median_segments(spark, sf_dir):
    """Median-threshold segments."""
    m = mart_for(spark, sf_dir)
    return rfm.rfm_median_segments(rfm.customer_rfm_metrics(m.fact_usd, m.as_of))


@register("rfm_median_summary", with_prelude(FACT_USD, RFM_METRICS, final="""
select *, total_revenue as total_sales, avg_recency as avg_recency_days from rfm_summary"""))
def q_rfm_median_summary(spark, sf_dir):
    """Segment summary."""
    m = mart_for(spark, sf_dir)
    return rfm.rfm_median_summary(rfm.rfm_median_segments(rfm.customer_rfm_metrics(m.fact_usd, m.as_of)))


@register("segment_actions", with_prelude(FACT_USD, RFM_METRICS, final="""
select *, total_revenue as total_sales, avg_recency as avg_recency_days,
  case segment when 'En Riesgo' then 'Campaña de reactivación / Visita comercial'
               when 'Campeones / VIP' then 'Trato preferencial y acuerdos de volumen'
               when 'Inactivos / Perdidos' then 'Ofertas especiales de reenganche'
               else 'Mantener fidelización' end as recommended_action
from rfm_summary"""))
def q_segment_actions(spark, sf_dir):
    """Recommended action per segment."""
    m = mart_for(spark, sf_dir)
    s = rfm.rfm_median_summary(rfm.rfm_median_segments(rfm.customer_rfm_metrics(m.fact_usd, m.as_of)))
    return rfm.segment_actions(s)


@register("top_ltv_customers", with_prelude(FACT_USD, RFM_METRICS, final="""
select * from rfm_metrics qualify row_number() over (
  order by gross_profit_ltv desc, customer_id, customer_name, customer_class_id, territory_name, salesperson_name) <= 20"""))
def q_top_ltv_customers(spark, sf_dir):
    """Top-20 customers by LTV (top-k is the feature)."""
    m = mart_for(spark, sf_dir)
    return rfm.top_ltv_customers(rfm.customer_rfm_metrics(m.fact_usd, m.as_of))


@register("customer_360_metrics", with_prelude(FACT_USD, SVC_CUSTOMERS, final=f"""
, t as (select customer_id, {MS('net_sales_amount')} as total_sales, {MS('gross_profit_amount')} as total_gross_profit,
          count(distinct invoice_number) as total_orders from fact_usd group by 1)
select c.*, coalesce(t.total_sales, 0.0) as total_sales, coalesce(t.total_gross_profit, 0.0) as total_gross_profit,
  coalesce(t.total_orders, 0) as total_orders,
  case when coalesce(t.total_orders, 0) > 0
    then {R('coalesce(t.total_sales, 0.0) / cast(coalesce(t.total_orders, 0) as double)', 2)} else 0.0 end
    as average_order_value
from svc_customers c left join t on c.customer_id = t.customer_id"""))
def q_customer_360_metrics(spark, sf_dir):
    """Customer 360 profile + totals for all customers."""
    m = mart_for(spark, sf_dir)
    return rfm.customer_360_metrics(m.fact_usd, m.service_customers)


@register("customer_recent_transactions", with_prelude(FACT_USD, final="""
select customer_id, cast(recency_rank as integer) as recency_rank, strftime(document_date, '%Y-%m-%d') as document_date,
  sop_type as document_type_id,
  invoice_number, line_item_sequence, item_number as item_id, item_description, quantity, net_sales_amount,
  gross_profit_amount, doc_type_desc
from (select *, row_number() over (partition by customer_id order by document_date desc, invoice_number desc,
        line_item_sequence desc, item_number desc, sop_type desc, quantity desc, net_sales_amount desc,
        gross_profit_amount desc, item_description desc) as recency_rank
      from fact_usd)
where recency_rank <= 15"""))
def q_customer_recent_transactions(spark, sf_dir):
    """15 most recent lines per customer (salted two-phase top-k)."""
    return rfm.customer_recent_transactions(mart_for(spark, sf_dir).fact_usd)


# ----------------------------------------------------------------------- A02
# Fifths of the customers who bought, by the documents counted above; ties by id.
RFM_QUINTILES = """
fifths as (
  select customer_id, ntile(5) over (order by last_day, customer_id) as late, ntile(5) over (order by docs, customer_id) as often,
    ntile(5) over (order by net, customer_id) as much
  from lifetime join stg_customers on customer_id = buyer),
rfm_q as (
  select customer_id, s.customer_name, s.customer_class_id, s.territory_id, s.days_since_last_purchase as recency_days,
    s.total_orders_count as frequency_orders, s.total_net_revenue as monetary_net_revenue, s.historical_ltv_gross_profit,
    s.average_order_value, s.current_churn_status, r_score, often::integer as f_score, much::integer as m_score,
    case when least(r_score, often, much) >= 4 then 'Champions / VIP'
         when least(r_score, often) >= 3 then 'Loyal Customers'
         when r_score >= 4 and often < 3 then 'Promising / Recent Buyers'
         when r_score < 3 and often >= 4 then 'At Risk / Need Attention'
         when greatest(r_score, often) = 1 then 'Hibernating / Churned'
         else 'Standard Customers' end as customer_rfm_segment
  from (select * exclude (late), late::integer as r_score from fifths) join summary s using (customer_id))
"""


@register("rfm_quintiles", with_prelude(ENRICHED, CUSTOMER_SUMMARY, RFM_QUINTILES, final=f"""
select {dbl('monetary_net_revenue', 'historical_ltv_gross_profit')} from rfm_q"""))
def q_rfm_quintiles(spark, sf_dir):
    """Quintile scores per customer (distributed global ntile)."""
    m = mart_for(spark, sf_dir)
    return rfm.rfm_quintiles(C.customer_orders_summary(m.sales_lines_enriched, m.stg_customers, m.as_of))


@register("rfm_segment_summary", with_prelude(ENRICHED, CUSTOMER_SUMMARY, RFM_QUINTILES, final=f"""
select customer_rfm_segment, current_churn_status, count(distinct customer_id) as total_customers,
  {R('cast(sum(recency_days) as double) / count(recency_days)', 1)} as avg_recency_days,
  {R('cast(sum(frequency_orders) as double) / count(frequency_orders)', 1)} as avg_orders_count,
  cast(round(sum(monetary_net_revenue), 2) as double) as total_revenue_contribution,
  {R('cast(sum(historical_ltv_gross_profit) as double) / count(historical_ltv_gross_profit)', 2)} as avg_historical_ltv
from rfm_q group by 1, 2 order by total_revenue_contribution desc, 1, 2"""))
def q_rfm_segment_summary(spark, sf_dir):
    """Segment × churn-status summary."""
    m = mart_for(spark, sf_dir)
    q = rfm.rfm_quintiles(C.customer_orders_summary(m.sales_lines_enriched, m.stg_customers, m.as_of))
    return rfm.rfm_segment_summary(q)
