"""Queries T01–T12: the staging models over the whole source tables; S01, S02: a text extract read with its types."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..mart import mart_for
from ..sources.extracts import typed
from .oracle_base import dbl, with_prelude
from .registry import register

# query name -> (Mart attribute, decimal columns reported as double)
STAGING = {
    "stg_customers": ("stg_customers", ("credit_limit_amount",)),
    "stg_customer_classes": ("stg_customer_classes", ("default_credit_limit_amount",)),
    "stg_salespeople": ("stg_salespeople", ()),
    "stg_territories": ("stg_territories", ()),
    "stg_sales_headers": ("stg_sales_headers", ("subtotal_amount", "total_doc_amount", "freight_amount",
                                                "misc_amount", "tax_amount", "trade_discount_amount",
                                                "discount_dollars_amount")),
    "stg_sales_lines": ("stg_sales_lines", ("quantity", "unit_price", "extended_price", "unit_cost",
                                            "extended_cost", "markdown_amount")),
    "stg_items": ("stg_items", ("standard_cost", "current_cost")),
    "stg_fx": ("stg_fx", ("exchange_rate",)),
    "stg_item_quantities": ("stg_item_quantities", ("qty_on_hand", "qty_allocated", "qty_available",
                                                    "qty_on_order", "qty_backorder", "safety_stock_qty",
                                                    "reorder_point_qty", "min_order_qty", "max_order_qty")),
    "stg_purchase_layers": ("stg_purchase_layers", ("qty_received", "qty_sold", "qty_on_hand_layer",
                                                    "unit_cost_vef")),
    "stg_inventory_transactions": ("stg_inventory_transactions", ("trx_qty", "unit_cost_vef",
                                                                  "extended_cost_vef")),
    "stg_open_ar": ("stg_open_ar", ("orig_amount_vef", "current_balance_vef")),
}


def _make(name: str, attr: str, decimals: tuple[str, ...]):
    select = dbl(*decimals) if decimals else "*"
    oracle = with_prelude(final=f"select {select} from {attr}")

    @register(name, oracle)
    def q(spark, sf_dir):
        return getattr(mart_for(spark, sf_dir), attr)

    q.__doc__ = f"Staging model {attr}."
    return q


for _name, (_attr, _decs) in STAGING.items():
    _make(_name, _attr, _decs)


# What is wrong in the text extract: quantities of every 101st order, dates of every 103rd, both in some.
_ORDER = "substr(SOPNUMBE, 4)::bigint"


@register("typed_extract", with_prelude(final=f"""
select case when bad_quantity and bad_date then 'DOCDATE: not date; QUANTITY: not decimal(19,4)'
            when bad_quantity then 'QUANTITY: not decimal(19,4)' when bad_date then 'DOCDATE: not date' else 'read' end as reason,
  count(*) as n_rows, cast(sum(if(bad_quantity or bad_date, null, XTNDPRCE)) as double) as extended_price
from (select *, {_ORDER} % 101 = 0 as bad_quantity, {_ORDER} % 103 = 0 as bad_date from SOP30300) group by 1"""))
def q_typed_extract(spark, sf_dir):
    """The lines as a text export with damaged values, read in the registry's types: rows and rejects by reason."""
    lines = mart_for(spark, sf_dir).src["SOP30300"]
    order = F.substring("SOPNUMBE", 4, 20).cast("long")
    text = lines.select(*[F.col(c).cast("string").alias(c) for c in lines.columns])
    text = text.withColumns({"QUANTITY": F.when(order % 101 == 0, F.lit("n/a")).otherwise(F.col("QUANTITY")),
                             "DOCDATE": F.when(order % 103 == 0, F.lit("1999-02-31")).otherwise(F.col("DOCDATE"))})
    read, rejects = typed(text, "SOP30300")
    good = read.agg(F.lit("read").alias("reason"), F.count(F.lit(1)).alias("n_rows"), F.sum("XTNDPRCE").cast("double").alias("extended_price"))
    bad = rejects.groupBy("reason").agg(F.count(F.lit(1)).alias("n_rows"))
    return good.unionByName(bad.withColumn("extended_price", F.lit(None).cast("double")))
