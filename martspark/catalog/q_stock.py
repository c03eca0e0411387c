"""Stock over time and by receipt: month-end balances and turnover on their average (M19), layers of the stock."""

from __future__ import annotations

from ..mart import mart_for
from ..operators import inventory, stock
from .oracle_base import AS_OF_SQL, dbl, with_prelude
from .oracle_common import ENRICHED
from .q_marts import MODEL_INV
from .q_sales import R
from .registry import register

# Every balance on its own: today's stock less the movements after the day.
MOVES = f"""
moves as (
  select item_number, from_location_code as location_code, doc_date,
    if(doc_type in (1, 5, 6), trx_qty, -trx_qty) as qty
  from stg_inventory_transactions where doc_type between 1 and 6
  union all
  select item_number, coalesce(to_location_code, 'DEFAULT_LOC'), doc_date, trx_qty
  from stg_inventory_transactions where doc_type = 3),
month_ends as (
  select if(k = 0, {AS_OF_SQL}, last_day(({AS_OF_SQL} - to_months(k::integer))::date)) as month_end,
    date_trunc('month', {AS_OF_SQL} - to_months(k::integer))::date as month_start
  from range(13) r(k)),
window_moves as (
  select * from moves where doc_date <= {AS_OF_SQL} and doc_date >= (select min(month_start) from month_ends))
"""


def _balances(keys: str, stock_rows: str) -> str:
    join = " and ".join(f"m.{k} = s.{k}" for k in keys.split(", "))
    return f"""
stock_now as (select {keys}, sum(qty_on_hand) as now from ({stock_rows}) group by all),
stock_keys as (select {keys} from stock_now union select {keys} from window_moves),
balances as (
  select {", ".join(f"s.{k}" for k in keys.split(", "))}, month_end,
    coalesce(sum(m.qty) filter (m.doc_date between month_start and month_end), 0) as net_qty,
    coalesce(any_value(n.now), 0) - coalesce(sum(m.qty) filter (m.doc_date > month_end), 0) as balance_qty
  from stock_keys s cross join month_ends left join stock_now n using ({keys})
  left join window_moves m on {join}
  group by all)
"""


@register("stock_month_end", with_prelude(MOVES, _balances("item_number, location_code", """
  select item_number, location_code, qty_on_hand from stg_item_quantities where record_type = 2"""), final=f"""
select {dbl('net_qty', 'balance_qty')} from balances"""))
def q_stock_month_end(spark, sf_dir):
    """M19 over time: stock of every item and location at the last 12 month ends and today."""
    m = mart_for(spark, sf_dir)
    return stock.month_end_stock(stock.location_stock(m.stg_item_quantities),
                                 stock.signed_movements(m.stg_inventory_transactions), m.as_of)


@register("inventory_turnover_average", with_prelude(ENRICHED, MODEL_INV, MOVES, _balances("item_number", """
  select item_number, qty_on_hand from stg_item_quantities where record_type = 1"""), final=f"""
, mean as (select item_number, cast(sum(balance_qty) as double) / count(*) as q from balances group by 1),
valued as (
  select v.*, coalesce(q, cast(qty_on_hand as double)) as q, coalesce(q, cast(qty_on_hand as double)) * unit_cost_usd as worth
  from inventory_valuation v left join mean using (item_number))
select item_number, cast(qty_on_hand as double) as qty_on_hand, {R('q', 4)} as average_qty, unit_cost_usd,
  {R('worth', 2)} as average_valuation_usd, total_valuation_usd, {R('annual_cogs_usd', 2)} as annual_cogs_usd,
  case when worth > 0 then {R('annual_cogs_usd / worth', 2)} else 0.0 end as average_inventory_turnover,
  case when annual_cogs_usd > 0 then {R('total_valuation_usd * 365 / annual_cogs_usd', 1)} else 999.0 end
    as days_inventory_outstanding
from valued"""))
def q_inventory_turnover_average(spark, sf_dir):
    """KPI 1.2: turnover on the average inventory of 13 month ends."""
    m = mart_for(spark, sf_dir)
    moves = stock.signed_movements(m.stg_inventory_transactions)
    ends = stock.month_end_stock(stock.item_stock(m.stg_item_quantities), moves, m.as_of, keys=("item_number",))
    return stock.average_turnover(m.inventory_valuation, ends)


@register("stock_layers", with_prelude(ENRICHED, MODEL_INV, final=f"""
, laid as (
  select l.*, sum(qty_on_hand_layer) over (partition by item_number
    order by date_received desc, receipt_sequence_num desc, receipt_number desc rows unbounded preceding) as reach
  from stg_purchase_layers l),
held as (select item_number, qty_on_hand as now, unit_cost_vef_used from inventory_valuation where qty_on_hand > 0),
filled as (
  select l.*, greatest(0, least(reach, now) - (reach - qty_on_hand_layer)) as allocated_qty from laid l join held using (item_number)),
every_piece as (
  select item_number, location_code, date_received, receipt_sequence_num, receipt_number, unit_cost_vef, allocated_qty
  from filled where allocated_qty > 0
  union all
  select item_number, null, null, null, null, cast(unit_cost_vef_used as decimal(19,4)), now - coalesce(used, 0)
  from held left join (select item_number, sum(allocated_qty) as used from filled group by 1) using (item_number)
  where now > coalesce(used, 0))
select {dbl('unit_cost_vef', 'allocated_qty')},
  {R('cast(allocated_qty as double) * cast(unit_cost_vef as double) / nullif((select r from model_fx), 0.0)', 2)}
    as allocated_value_usd
from every_piece"""))
def q_stock_layers(spark, sf_dir):
    """M21 against on-hand: today's stock by the receipt layers it lies in."""
    m = mart_for(spark, sf_dir)
    return stock.stock_layers(m.stg_purchase_layers, m.inventory_valuation, inventory.latest_model_rate(m.stg_fx))
