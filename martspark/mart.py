"""One place that wires sources → staging → marts for a data directory.

``Mart`` exposes every intermediate frame as a lazily built DataFrame.  Nothing
is computed when a property is read; each query composes the plans it needs
and Catalyst optimizes the whole chain from the parquet scans to the result.
"""

from __future__ import annotations

import datetime as dt
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .operators import customers, dims, facts, fx, inventory, org, receivables, sales, staging
from .plans.stage import stage
from .session import prepare, session_key
from .sources.binding import sources_for

# Fixed value: the reporting date used by all tests and oracles.
AS_OF = dt.date(2001, 8, 2)


class Mart:
    def __init__(self, spark: SparkSession, sf_dir: str, as_of: dt.date = AS_OF):
        self.spark = prepare(spark)
        self.sf_dir = sf_dir
        self.as_of = as_of
        self.src = sources_for(spark, sf_dir)
        self.written: set[str] = set()  # frames that are read from files

    # ----------------------------------------------------------------- staging
    @cached_property
    def stg_customers(self) -> DataFrame:
        return staging.stg_customers(self.src["RM00101"])

    @cached_property
    def stg_customer_classes(self) -> DataFrame:
        return staging.stg_customer_classes(self.src["RM00201"])

    @cached_property
    def stg_salespeople(self) -> DataFrame:
        return staging.stg_salespeople(self.src["RM00301"])

    @cached_property
    def stg_territories(self) -> DataFrame:
        return staging.stg_territories(self.src["RM00303"])

    @cached_property
    def stg_sales_headers(self) -> DataFrame:
        return staging.stg_sales_headers(self.src["SOP30200"])

    @cached_property
    def stg_sales_lines(self) -> DataFrame:
        return staging.stg_sales_lines(self.src["SOP30300"])

    @cached_property
    def stg_items(self) -> DataFrame:
        return staging.stg_items(self.src["IV00101"])

    @cached_property
    def stg_fx(self) -> DataFrame:
        return staging.stg_fx(self.src["MC00100"])

    @cached_property
    def stg_item_quantities(self) -> DataFrame:
        return staging.stg_item_quantities(self.src["IV00102"])

    @cached_property
    def stg_purchase_layers(self) -> DataFrame:
        return staging.stg_purchase_layers(self.src["IV10200"])

    @cached_property
    def stg_inventory_transactions(self) -> DataFrame:
        return staging.stg_inventory_transactions(self.src["IV30300"])

    @cached_property
    def stg_open_ar(self) -> DataFrame:
        return staging.stg_open_ar(self.src["RM20101"])

    # ------------------------------------------------------------ model layer
    @cached_property
    def sales_lines_enriched(self) -> DataFrame:
        return sales.sales_lines_enriched(self.stg_sales_headers, self.stg_sales_lines)

    # ---------------------------------------------------------- service layer
    @cached_property
    def rates(self) -> DataFrame:
        return fx.service_rates(self.src["MC00100"])

    @cached_property
    def fact_usd(self) -> DataFrame:
        s = self.src
        return sales.service_sales_fact(s["SOP30200"], s["SOP30300"], s["RM00101"], s["RM00301"], s["RM00303"],
                                        s["IV00101"], self.rates, self.as_of)

    @cached_property
    def service_customers(self) -> DataFrame:
        s = self.src
        return org.service_customers(s["RM00101"], s["RM00301"], s["RM00303"])

    @cached_property
    def service_salespeople(self) -> DataFrame:
        return org.service_salespeople(self.src["RM00301"], self.src["RM00303"])

    @cached_property
    def service_territories(self) -> DataFrame:
        return org.service_territories(self.src["RM00303"])

    @cached_property
    def latest_rate(self):
        """Service latest rate (scalar subquery column)."""
        return fx.latest_rate(self.rates)

    # -------------------------------------------------------------- dimensions
    @cached_property
    def dim_customer(self) -> DataFrame:
        return dims.dim_customer(self.stg_customers, self.stg_customer_classes)

    @cached_property
    def dim_product(self) -> DataFrame:
        return dims.dim_product(self.stg_items)

    @cached_property
    def dim_salesperson(self) -> DataFrame:
        return dims.dim_salesperson(self.stg_salespeople)

    @cached_property
    def dim_territory(self) -> DataFrame:
        return dims.dim_territory(self.stg_territories)

    @cached_property
    def calendar(self) -> DataFrame:
        """Every day from the first to the last date that any fact refers to."""
        h, ar, trx = self.stg_sales_headers, self.stg_open_ar, self.stg_inventory_transactions
        today = self.spark.range(1).select(F.lit(self.as_of).alias("as_of"))
        months = h.select(F.trunc("document_date", "month").alias("m"))
        return dims.data_calendar((h, "document_date"), (months, "m"), (h, "gl_post_date"), (ar, "doc_date"),
                                  (ar, "due_date"), (trx, "doc_date"), (today, "as_of"))

    @cached_property
    def dim_date(self) -> DataFrame:
        return dims.dim_date(self.calendar)

    @cached_property
    def dim_location(self) -> DataFrame:
        return facts.dim_location(self.src["IV40700"])

    @cached_property
    def fact_sales(self) -> DataFrame:
        dimensions = self.dim_customer, self.dim_product, self.dim_salesperson, self.dim_territory
        if "sales_lines_enriched" in self.written:
            return facts.fact_sales(self.sales_lines_enriched, *dimensions)
        # wide lines are not shuffled to the dimensions: documents are, and lines before their metrics
        headers = facts.document_keys(sales.with_unknown_org(self.stg_sales_headers), self.dim_customer,
                                      self.dim_salesperson, self.dim_territory)
        lines = facts.product_key(sales.document_lines(headers, self.stg_sales_lines, facts.DOCUMENT_KEYS), self.dim_product)
        return facts.fact_sales(sales.line_metrics(lines, (*facts.DOCUMENT_KEYS, "product_sk")), *dimensions)

    @cached_property
    def fact_customer_monthly_snapshot(self) -> DataFrame:
        return facts.fact_customer_monthly_snapshot(self.customer_monthly, self.dim_customer, self.dim_salesperson,
                                                    self.dim_territory)

    def staged(self, *names: str) -> "Mart":
        """A Mart whose named frames are written once to the shared folder, for
        queries in which several branches read them."""
        out = Mart(self.spark, self.sf_dir, self.as_of)
        for name in names:
            out.__dict__[name] = stage(getattr(out, name), name)
            out.written.add(name)
        return out

    # -------------------------------------------------------------- customers
    @cached_property
    def customer_summary(self) -> DataFrame:
        return customers.customer_orders_summary(self.sales_lines_enriched, self.stg_customers, self.as_of)

    @cached_property
    def customer_monthly(self) -> DataFrame:
        return customers.customer_monthly(self.sales_lines_enriched)

    # -------------------------------------------------------------- inventory
    @cached_property
    def inventory_valuation(self) -> DataFrame:
        return inventory.inventory_valuation(self.stg_item_quantities, self.stg_items, self.sales_lines_enriched,
                                             self.stg_fx, self.as_of)

    @cached_property
    def service_stock(self) -> DataFrame:
        return inventory.service_stock(self.src["IV00102"], self.src["IV00101"])

    @cached_property
    def item_cogs_12m(self) -> DataFrame:
        return inventory.item_cogs_12m(self.src["SOP30200"], self.src["SOP30300"], self.as_of)

    @cached_property
    def inventory_items(self) -> DataFrame:
        return inventory.inventory_items(self.service_stock, self.item_cogs_12m, self.latest_rate)

    # ------------------------------------------------------------ receivables
    @cached_property
    def ar_documents(self) -> DataFrame:
        s = self.src
        return receivables.ar_documents(s["RM20101"], s["RM00101"], s["RM00301"], s["RM00303"],
                                        self.latest_rate, self.as_of)

    @cached_property
    def sales_90d_usd(self):
        return receivables.sales_90d_usd(self.src["SOP30200"], self.src["SOP30300"], self.latest_rate, self.as_of)

    # ----------------------------------------------------------------- serving
    SERVED = ("fact_usd", "service_customers", "inventory_items", "ar_documents", "sales_lines_enriched")

    def serve_from(self, target_dir: str) -> dict[str, int]:
        """Materialise the frames the dashboard queries share (the service's
        in-memory frames of the reference) as parquet under ``target_dir`` and
        make this Mart read them: one refresh, many cheap queries.  Returns the
        written row counts."""
        from .streaming.refresh import refresh_all
        frames = {name: getattr(self, name) for name in self.SERVED}
        counts = refresh_all(frames, target_dir, {})
        for name in self.SERVED:
            self.__dict__[name] = self.spark.read.parquet(f"{target_dir.rstrip('/')}/{name}")
            self.written.add(name)
        return counts


_MARTS: dict[tuple[str, str], Mart] = {}


def mart_for(spark: SparkSession, sf_dir: str) -> Mart:
    """One ``Mart`` per (application, directory); those of an earlier application are dropped."""
    app = session_key(spark)
    key = (app, sf_dir.rstrip("/"))
    for old in [k for k in _MARTS if k[0] != app]:
        del _MARTS[old]
    if key not in _MARTS:
        _MARTS[key] = Mart(spark, sf_dir)
    return _MARTS[key]
