"""Data quality (G01–G06, G09): rules as data, evaluated in as few passes as possible.

Every row-level rule on one table (not null, in set, between, row count) is
compiled into a single ``agg`` over that table, so a suite of N rules costs one
scan, not N.  Uniqueness rules need a ``groupBy`` on their key (one shuffle per
key set, partial aggregation first).  The result is one row per rule with the
observed counts and the verdict — the evaluator really reads the data.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.broadcast import small
from ..plans.stage import stage


@dataclass(frozen=True)
class Rule:
    rule_id: int
    table: str
    kind: str  # row_count_between | not_null | unique | compound_unique | in_set | between
    columns: tuple[str, ...] = ()
    dimension: str = "General"
    params: dict = field(default_factory=dict, hash=False, compare=False)

    @property
    def column_text(self) -> str:
        return ",".join(self.columns)


# The expectation suite of the sales mart (11 rules, 7 dimensions).
SALES_SUITE = (
    Rule(1, "sales_lines", "row_count_between", (), "Completeness", {"min": 1, "max": 100_000_000}),
    Rule(2, "sales_lines", "not_null", ("invoice_number",), "Completeness"),
    Rule(3, "sales_lines", "not_null", ("customer_id",), "Completeness"),
    Rule(4, "sales_lines", "not_null", ("document_date",), "Completeness"),
    Rule(5, "sales_lines", "compound_unique", ("invoice_number", "line_item_sequence", "component_sequence"),
         "Uniqueness"),
    Rule(6, "sales_lines", "in_set", ("sop_type",), "Validity", {"values": (3, 4)}),
    Rule(7, "sales_lines", "between", ("unit_price",), "Accuracy", {"min": 0.0}),
    Rule(8, "sales_lines", "between", ("unit_cost",), "Accuracy", {"min": 0.0}),
    Rule(9, "sales_lines", "between", ("document_date",), "Timeliness", {"min": "2000-01-01", "max": "2099-12-31"}),
    Rule(10, "sales_lines", "in_set", ("is_voided",), "Integrity", {"values": (0,)}),
    Rule(11, "customer_monthly", "in_set", ("is_churned_flag",), "Consistency", {"values": (0, 1)}),
)

# Declared column tests of the model layers (table, column, tests).
COLUMN_TESTS = (
    ("stg_customers", "customer_id", ("not_null", "unique")),
    ("stg_customers", "customer_name", ("not_null",)),
    ("stg_sales_headers", "invoice_number", ("not_null",)),
    ("stg_sales_headers", "sop_type", ("not_null", ("accepted_values", (1, 2, 3, 4, 5, 6)))),
    ("stg_sales_lines", "invoice_number", ("not_null",)),
    ("stg_sales_lines", "line_item_sequence", ("not_null",)),
    ("stg_items", "item_number", ("not_null", "unique")),
    ("sales_lines_enriched", "invoice_number", ("not_null",)),
    ("sales_lines_enriched", "line_item_sequence", ("not_null",)),
    ("sales_lines_enriched", "net_sales_amount", ("not_null",)),
    ("sales_lines_enriched", "customer_id", ("not_null",)),
    ("customer_orders_summary", "customer_id", ("not_null", "unique")),
    ("customer_orders_summary", "historical_ltv_gross_profit", ("not_null",)),
    ("customer_orders_summary", "current_churn_status",
     ("not_null", ("accepted_values", ("Active", "Churned / Inactive", "Never Purchased")))),
    ("customer_monthly", "customer_id", ("not_null",)),
    ("customer_monthly", "year_month_sk", ("not_null",)),
    ("customer_monthly", "is_churned_flag", ("not_null", ("accepted_values", (0, 1)))),
    ("dim_customer", "customer_sk", ("not_null", "unique")),
    ("dim_customer", "customer_id", ("not_null",)),
    ("dim_product", "product_sk", ("not_null", "unique")),
    ("dim_product", "item_number", ("not_null",)),
    ("dim_date", "date_sk", ("not_null", "unique")),
    ("fact_sales", "sales_fact_sk", ("not_null", "unique")),
    ("fact_sales", "customer_sk", ("not_null",)),
    ("fact_sales", "product_sk", ("not_null",)),
    ("fact_sales", "document_date_sk", ("not_null",)),
    ("fact_customer_monthly_snapshot", "snapshot_sk", ("not_null", "unique")),
    ("fact_customer_monthly_snapshot", "customer_id", ("not_null",)),
    ("fact_customer_monthly_snapshot", "year_month_sk", ("not_null",)),
)


# Expectation type of a JSON suite -> rule kind and its argument names.
_SUITE_KINDS = {
    "expect_table_row_count_to_be_between": ("row_count_between", {"min_value": "min", "max_value": "max"}),
    "expect_column_values_to_not_be_null": ("not_null", {}),
    "expect_column_values_to_be_unique": ("unique", {}),
    "expect_compound_columns_to_be_unique": ("compound_unique", {}),
    "expect_column_values_to_be_in_set": ("in_set", {"value_set": "values"}),
    "expect_column_values_to_be_between": ("between", {"min_value": "min", "max_value": "max"}),
}


def load_suite(text: str, table: str) -> tuple[Rule, ...]:
    """The rules of a JSON expectation suite (its text), in order, for ``table``.

    Unknown expectation types are an error, never skipped; a rule without a
    dimension belongs to ``General``."""
    rules = []
    for n, e in enumerate(json.loads(text).get("expectations", []), 1):
        if e.get("expectation_type") not in _SUITE_KINDS:
            raise ValueError(f"expectation {n}: unknown type {e.get('expectation_type')!r}")
        kind, names = _SUITE_KINDS[e["expectation_type"]]
        args = e.get("kwargs", {})
        columns = tuple(args.get("column_list", ())) or ((args["column"],) if "column" in args else ())
        params = {to: tuple(args[k]) if to == "values" else args[k] for k, to in names.items() if args.get(k) is not None}
        rules.append(Rule(n, table, kind, columns, e.get("meta", {}).get("dimension", "General"), params))
    return tuple(rules)


def column_test_rules() -> tuple[Rule, ...]:
    """The declared column tests as evaluator rules."""
    rules = []
    n = 0
    for table, column, tests in COLUMN_TESTS:
        for t in tests:
            n += 1
            if isinstance(t, tuple):
                rules.append(Rule(n, table, "in_set", (column,), "Validity", {"values": t[1]}))
            elif t == "unique":
                rules.append(Rule(n, table, "unique", (column,), "Uniqueness"))
            else:
                rules.append(Rule(n, table, "not_null", (column,), "Completeness"))
    return tuple(rules)


def _lit(v) -> Column:
    return F.lit(v)


def _violation(rule: Rule) -> Column:
    """Row-level 'unexpected' predicate (NULLs are only unexpected for not_null)."""
    if rule.kind == "not_null":
        return F.col(rule.columns[0]).isNull()
    c = F.col(rule.columns[0])
    if rule.kind == "in_set":
        return c.isNotNull() & ~c.isin(*rule.params["values"])
    if rule.kind == "between":
        lo, hi = rule.params.get("min"), rule.params.get("max")
        if isinstance(lo, str) or isinstance(hi, str):
            c = c.cast("date")
            lo = F.lit(lo).cast("date") if lo is not None else None
            hi = F.lit(hi).cast("date") if hi is not None else None
        else:
            lo = _lit(lo) if lo is not None else None
            hi = _lit(hi) if hi is not None else None
        bad = F.lit(False)
        if lo is not None:
            bad = bad | (c < lo)
        if hi is not None:
            bad = bad | (c > hi)
        return c.isNotNull() & bad
    raise ValueError(rule.kind)


def _result_row(rule: Rule, element_count: Column, unexpected: Column, success: Column) -> Column:
    return F.struct(
        F.lit(rule.rule_id).alias("rule_id"), F.lit(rule.table).alias("table_name"),
        F.lit(rule.kind).alias("expectation"), F.lit(rule.column_text).alias("columns"),
        F.lit(rule.dimension).alias("dimension"), element_count.cast("bigint").alias("element_count"),
        unexpected.cast("bigint").alias("unexpected_count"), success.alias("success"))


def evaluate(frames: dict[str, DataFrame], rules: tuple[Rule, ...]) -> DataFrame:
    """Evaluate ``rules`` on ``frames``: one aggregate per table plus one
    group-by per uniqueness key; returns one row per rule."""
    parts: list[DataFrame] = []
    by_table: dict[str, list[Rule]] = {}
    for r in rules:
        by_table.setdefault(r.table, []).append(r)
    for table, trs in by_table.items():
        df = frames[table]
        row_rules = [r for r in trs if r.kind not in ("unique", "compound_unique")]
        aggs = [F.count(F.lit(1)).alias("_n")]
        for r in row_rules:
            if r.kind != "row_count_between":
                aggs.append(F.count_if(_violation(r)).alias(f"_u{r.rule_id}"))
        one = df.agg(*aggs)
        structs = []
        for r in row_rules:
            n = F.col("_n")
            if r.kind == "row_count_between":
                ok = F.lit(True)
                if "min" in r.params:
                    ok = ok & (n >= r.params["min"])
                if "max" in r.params:
                    ok = ok & (n <= r.params["max"])
                structs.append(_result_row(r, n, F.lit(0), ok))
            else:
                u = F.col(f"_u{r.rule_id}")
                structs.append(_result_row(r, n, u, u == 0))
        if structs:
            parts.append(one.select(F.explode(F.array(*structs)).alias("r")).select("r.*"))
        for r in trs:
            if r.kind in ("unique", "compound_unique"):
                # one pass: group by the key (NULL keys form their own groups and
                # are never duplicates), then duplicate rows and total rows
                keys = [F.col(c) for c in r.columns]
                g = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_c"))
                notnull = F.lit(True)
                for c in r.columns:
                    notnull = notnull & F.col(c).isNotNull()
                row = g.agg(F.coalesce(F.sum(F.when((F.col("_c") > 1) & notnull, F.col("_c"))), F.lit(0)).alias("_u"),
                            F.coalesce(F.sum("_c"), F.lit(0)).alias("_n"))
                parts.append(row.select(_result_row(r, F.col("_n"), F.col("_u"), F.col("_u") == 0).alias("r"))
                             .select("r.*"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.orderBy("table_name", "rule_id")


def by_dimension(results: DataFrame) -> DataFrame:
    """Rules, passed, failed and unexpected rows per quality dimension."""
    return results.groupBy("dimension").agg(
        F.count(F.lit(1)).alias("rules"),
        F.count_if(F.col("success")).alias("passed"),
        F.count_if(~F.col("success")).alias("failed"),
        F.sum("unexpected_count").alias("unexpected_rows"),
    ).orderBy("dimension")


# ----------------------------------------------------------------------- G04
def referential(facts: dict[str, tuple[DataFrame, dict[str, tuple[DataFrame, str]]]]) -> DataFrame:
    """Per fact and foreign key, fact rows whose (non-null) key has no
    dimension row.  A dimension's keys are computed once for all facts, and the
    rows of each key value are counted first: one row per value meets them."""
    parts, members = [], {}
    for table, (fact, checks) in facts.items():
        d = stage(fact.select(*checks), table)  # the keys alone, computed once
        for fk, (dim, pk) in checks.items():
            if (id(dim), pk) not in members:
                members[id(dim), pk] = stage(dim.select(F.col(pk).alias("_pk")).distinct(), f"{pk}-members")
            values = d.groupBy(F.col(fk).alias("_fk")).agg(F.count(F.lit(1)).alias("n"))
            orphan = F.col("_fk").isNotNull() & F.col("_pk").isNull()
            counts = values.join(small(members[id(dim), pk]), F.col("_fk") == F.col("_pk"), "left").agg(
                F.coalesce(F.sum("n"), F.lit(0)).alias("fact_rows"),
                F.coalesce(F.sum(F.when(orphan, F.col("n"))), F.lit(0)).alias("orphan_rows"))
            parts.append(counts.select(F.lit(table).alias("table_name"), F.lit(fk).alias("foreign_key"), "fact_rows",
                                       "orphan_rows", (F.col("orphan_rows") == 0).alias("success")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# ----------------------------------------------------------------------- G05
UNKNOWN_CUSTOMER_REASON = "UNKNOWN_CUSTOMER"
NULL_AMOUNT_REASON = "NULL_AMOUNT"


def known_customers(rows: DataFrame, customers: DataFrame, key: str = "customer_id") -> DataFrame:
    """Rows with ``_known`` (NULL where no customer has the key), for documents before they meet their lines."""
    ck = small(customers.select(F.col(key).alias("_ck")).distinct().withColumn("_known", F.lit(True)))
    return rows.join(ck, rows[key] == ck["_ck"], "left").drop("_ck")


def quarantine(lines: DataFrame, customers: DataFrame, key: str = "customer_id",
               amount: str = "net_sales_amount") -> DataFrame:
    """Every line with ``quarantine_reason`` (NULL = clean).

    Unknown customers are found with a left join to the distinct customer keys
    (broadcast when small), unless the lines have it from their documents
    (``known_customers``); the pipeline continues with the clean rows.
    """
    j = lines if "_known" in lines.columns else known_customers(lines, customers, key)
    reason = (F.when(F.col("_known").isNull(), F.lit(UNKNOWN_CUSTOMER_REASON))
              .when(F.col(amount).isNull(), F.lit(NULL_AMOUNT_REASON)))
    return j.select(*[F.col(c) for c in lines.columns if c != "_known"], reason.alias("quarantine_reason"))


def split_quarantine(lines: DataFrame, customers: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(clean, quarantined) frames."""
    q = quarantine(lines, customers)
    return (q.where(F.col("quarantine_reason").isNull()).drop("quarantine_reason"),
            q.where(F.col("quarantine_reason").isNotNull()))


# ----------------------------------------------------------------------- G06
CONTRACT_RULES = (
    Rule(1, "fact_sales", "unique", ("sales_fact_sk",), "Uniqueness"),
    Rule(2, "fact_sales", "compound_unique", ("invoice_number", "line_item_sequence", "component_sequence"),
         "Uniqueness"),
    Rule(3, "fact_sales", "not_null", ("invoice_number",), "Completeness"),
    Rule(4, "fact_sales", "not_null", ("customer_sk",), "Completeness"),
    Rule(5, "fact_sales", "not_null", ("product_sk",), "Completeness"),
    Rule(6, "fact_sales", "not_null", ("document_date_sk",), "Completeness"),
    Rule(7, "fact_sales", "not_null", ("net_sales_amount",), "Completeness"),
)


def contract(fact_sales: DataFrame) -> DataFrame:
    """Data contract of the sales fact (keys, uniqueness, non-null fields),
    plus a schema check that every contract column exists.  A rule on a missing
    column fails on every row."""
    needed = sorted({c for r in CONTRACT_RULES for c in r.columns})
    missing = [c for c in needed if c not in fact_sales.columns]
    checked = tuple(r for r in CONTRACT_RULES if not set(r.columns) & set(missing))
    failed = [r for r in CONTRACT_RULES if r not in checked]
    rows = fact_sales.agg(F.count(F.lit(1)).alias("n"))
    parts = ([evaluate({"fact_sales": fact_sales}, checked)] if checked else []) + [
        rows.select(_result_row(r, F.col("n"), F.col("n"), F.lit(False)).alias("r")).select("r.*") for r in failed]
    res = reduce(DataFrame.unionByName, parts)
    schema_row = res.sparkSession.range(1).select(
        F.lit(0).alias("rule_id"), F.lit("fact_sales").alias("table_name"), F.lit("schema_columns").alias("expectation"),
        F.lit(",".join(needed)).alias("columns"), F.lit("Consistency").alias("dimension"),
        F.lit(len(needed)).cast("bigint").alias("element_count"),
        F.lit(len(missing)).cast("bigint").alias("unexpected_count"), F.lit(not missing).alias("success"))
    return res.unionByName(schema_row).orderBy("rule_id")


# ----------------------------------------------------------------------- G09
def freshness(df: DataFrame, date_col: str, as_of, table: str, sla_days: int = 1) -> DataFrame:
    """Latest date in ``df`` against the daily SLA at ``as_of``."""
    a = F.lit(as_of)
    return df.agg(F.max(date_col).alias("max_date")).select(
        F.lit(table).alias("table_name"), "max_date", a.alias("as_of"),
        F.datediff(a, F.col("max_date")).alias("lag_days"), F.lit(sla_days).alias("sla_days"),
        (F.datediff(a, F.col("max_date")) <= sla_days).alias("is_fresh"))
