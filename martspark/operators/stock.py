"""Stock over time and by receipt: month-end balances walked back from today's
stock, turnover on the average of them (M19, inventory KPI 1.2), and on-hand
stock allocated to the receipt layers it consists of (M21).

Movements have a direction by type: adjustments in, purchase receipts and
returns add, adjustments out and sales take away, transfers do both, other types
have no direction and do not move stock.  Blank locations are ``DEFAULT_LOC``.

Scale: movements are reduced to one row per item and location with one sum for each
month (a single algebraic aggregate, a hot item is combined before the shuffle);
the walk back is then a sum of at most ``months`` columns, no window.  The running
sum over receipt layers is split into range pieces (``plans.ranking.keyed_running_sum``).
"""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import labels as L
from ..functions.numeric import ratio_or, rnd
from ..plans.ranking import keyed_running_sum
from .customers import month_index
from .sales import _date

# Direction of the movement types (IV30300.DOCTYPE).
TYPES_IN = (1, 5, 6)
TYPES_OUT = (2, 4)
TYPE_TRANSFER = 3


def signed_movements(trx: DataFrame) -> DataFrame:
    """(item_number, location_code, doc_date, qty): every effect of a movement on the stock of a location."""
    kind, qty = F.col("doc_type"), F.col("trx_qty")
    own = F.when(kind.isin(*TYPES_IN), qty).when(kind.isin(*TYPES_OUT, TYPE_TRANSFER), -qty)
    effects = F.array(
        F.struct(F.col("from_location_code").alias("location_code"), own.alias("qty")),
        F.struct(F.coalesce("to_location_code", F.lit(L.DEFAULT_LOCATION)).alias("location_code"),
                 F.when(kind == TYPE_TRANSFER, qty).alias("qty")))
    return trx.select("item_number", "doc_date", F.explode(effects).alias("e")).select(
        "item_number", "e.location_code", "doc_date", "e.qty").where(F.col("qty").isNotNull())


def month_end_stock(stock: DataFrame, movements: DataFrame, as_of, months: int = 12,
                    keys: tuple[str, ...] = ("item_number", "location_code")) -> DataFrame:
    """(keys, month_end, net_qty, balance_qty): stock at the end of the ``months`` months before ``as_of`` and at
    ``as_of`` itself, from today's ``stock`` (keys, qty_on_hand) back over the movements dated after each day.
    Keys with movements only have no stock today.  Movements after ``as_of`` are not counted."""
    today = _date(as_of)
    back = month_index(today) - month_index(F.col("doc_date"))
    recent = movements.where((F.col("doc_date") <= today) & (back < months + 1))
    net = recent.groupBy(*keys).agg(*[F.sum(F.when(back == k, F.col("qty"))).alias(f"_n{k}") for k in range(months + 1)])
    held = stock.groupBy(*keys).agg(F.sum("qty_on_hand").alias("_now"))
    j = held.join(net, list(keys), "full_outer")
    zero = F.lit(0).cast("decimal(29,4)")
    moved = [F.coalesce(f"_n{k}", zero) for k in range(months + 1)]
    points = []
    for k in range(months + 1):
        end = today if k == 0 else F.last_day(F.add_months(today, -k))
        balance = F.coalesce("_now", zero) - (reduce(add, moved[:k]) if k else zero)
        points.append(F.struct(end.alias("month_end"), moved[k].cast("decimal(29,4)").alias("net_qty"),
                               balance.cast("decimal(29,4)").alias("balance_qty")))
    return j.select(*keys, F.explode(F.array(*points)).alias("p")).select(*keys, "p.*")


def item_stock(stg_quantities: DataFrame) -> DataFrame:
    """Item totals (record type 1)."""
    return stg_quantities.where(F.col("record_type") == 1).select("item_number", "qty_on_hand")


def location_stock(stg_quantities: DataFrame) -> DataFrame:
    """Stock by warehouse (record type 2)."""
    return stg_quantities.where(F.col("record_type") == 2).select(
        "item_number", F.coalesce("location_code", F.lit(L.DEFAULT_LOCATION)).alias("location_code"), "qty_on_hand")


def average_turnover(valuation: DataFrame, balances: DataFrame) -> DataFrame:
    """Turnover and DIO of every stocked item on its average month-end value.

    ``balances`` are the item's month ends (item_number, balance_qty); they are
    valued at the unit cost of the valuation.  DIO is today's value over daily COGS."""
    mean = balances.groupBy(F.col("item_number").alias("b_item")).agg(
        F.sum("balance_qty").alias("_sum"), F.count(F.lit(1)).alias("_n"))
    j = valuation.join(mean, F.col("item_number") == F.col("b_item"), "left")
    quantity = F.coalesce(F.col("_sum").cast("double") / F.col("_n"), F.col("qty_on_hand").cast("double"))
    value = quantity * F.col("unit_cost_usd")
    cogs = F.col("annual_cogs_usd")
    return j.select(
        "item_number", "qty_on_hand", rnd(quantity, 4).alias("average_qty"), "unit_cost_usd",
        rnd(value, 2).alias("average_valuation_usd"), "total_valuation_usd", rnd(cogs, 2).alias("annual_cogs_usd"),
        ratio_or(cogs, value, value > 0, 0.0, 2).alias("average_inventory_turnover"),
        ratio_or(F.col("total_valuation_usd") * 365, cogs, cogs > 0, 999.0, 1).alias("days_inventory_outstanding"))


def stock_layers(stg_layers: DataFrame, valuation: DataFrame, fx_rate: Column) -> DataFrame:
    """M21 against on-hand: which receipt layers today's stock consists of.

    Stock leaves oldest first, so what is on hand lies in the newest open layers:
    an item's layers are laid end to end, newest first, and its stock covers them
    from the start.  A layer holds the overlap of its interval with the stock's;
    stock beyond all layers is one row without a receipt, at the item's cost.
    The quantities of an item add up to its stock (none for a stock of 0 or less)."""
    order = [F.col("date_received").desc(), F.col("receipt_sequence_num").desc(), F.col("receipt_number").desc()]
    columns = ["item_number", "location_code", "date_received", "receipt_sequence_num", "receipt_number",
               "qty_on_hand_layer", "unit_cost_vef"]
    laid = keyed_running_sum(stg_layers.select(*columns), ["item_number"], order, "qty_on_hand_layer", "_end")
    held = valuation.where(F.col("qty_on_hand") > 0).select(
        F.col("item_number").alias("v_item"), F.col("qty_on_hand").alias("_stock"), "unit_cost_vef_used")
    start = F.col("_end") - F.col("qty_on_hand_layer")
    covered = laid.join(held, F.col("item_number") == F.col("v_item")).where(start < F.col("_stock"))
    rows = covered.select(*[c for c in columns if c != "qty_on_hand_layer"],
                          (F.least("_end", "_stock") - start).cast("decimal(29,4)").alias("allocated_qty"))
    total = rows.groupBy(F.col("item_number").alias("t_item")).agg(F.sum("allocated_qty").alias("_covered"))
    rest = held.join(total, F.col("v_item") == F.col("t_item"), "left")
    left_over = (F.col("_stock") - F.coalesce("_covered", F.lit(0))).cast("decimal(29,4)")
    rest = rest.where(left_over > 0).select(
        F.col("v_item").alias("item_number"), F.lit(None).cast("string").alias("location_code"),
        F.lit(None).cast("date").alias("date_received"), F.lit(None).cast("int").alias("receipt_sequence_num"),
        F.lit(None).cast("string").alias("receipt_number"),
        F.col("unit_cost_vef_used").cast("decimal(19,4)").alias("unit_cost_vef"), left_over.alias("allocated_qty"))
    out = rows.unionByName(rest)
    value = F.col("allocated_qty").cast("double") * F.col("unit_cost_vef").cast("double")
    return out.select("*", rnd(value / F.nullif(fx_rate, F.lit(0.0)), 2).alias("allocated_value_usd"))
