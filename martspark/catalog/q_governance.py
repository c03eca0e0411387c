"""Governance queries: SCD2 (M13–M15), data quality (G01–G06, G09),
privacy (G07, G08) and the refresh counts (S10)."""

from __future__ import annotations

from functools import reduce
from pathlib import Path

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..mart import mart_for
from ..functions import labels as L
from ..operators import customers, dims, facts, inventory, privacy, quality, sales, scd2
from ..plans.stage import discard, stage
from .oracle_base import AS_OF_SQL, dbl, with_prelude
from .oracle_common import CUSTOMER_MONTHLY, CUSTOMER_SUMMARY, ENRICHED, FACT_USD, SVC_CUSTOMERS
from .q_marts import CALENDAR, DIMS, FACT_SALES_SQL, LOCATIONS, MODEL_INV
from .registry import ORACLES, register

# Fixed value: load time of the second customer extract.
SCD2_LOAD_TS = "1998-01-01 00:00:00"

# What changed between the first and the second extract of the customers.
MOVE_TERRITORY_MODIFIED_FROM = "1997-01-01 00:00:00"
CLEAR_CLASS_MODIFIED = ("1996-07-01 00:00:00", "1997-01-01 00:00:00")
UNTRACKED_MODIFIED_BEFORE = "1995-04-01 00:00:00"
MOVED_TERRITORY = "99"


def second_extract(stg_customers: DataFrame) -> DataFrame:
    """Every customer again: those modified since 1997 moved territory, those
    modified in the second half of 1996 lost their class, and those modified
    before April 1995 changed an untracked column."""
    m = F.col("modified_at")
    lo, hi = (scd2.ts(x) for x in CLEAR_CLASS_MODIFIED)
    changes = {
        "territory_id": F.when(m >= scd2.ts(MOVE_TERRITORY_MODIFIED_FROM), F.lit(MOVED_TERRITORY))
        .otherwise(F.col("territory_id")),
        "customer_class_id": F.when((m >= lo) & (m < hi), F.lit(None).cast("string")).otherwise(F.col("customer_class_id")),
        "city": F.when(m < scd2.ts(UNTRACKED_MODIFIED_BEFORE), F.concat("city", F.lit(" Norte"))).otherwise(F.col("city")),
    }
    return stg_customers.select(*[changes.get(c, F.col(c)).alias(c) for c in scd2.SNAPSHOT_COLS])


def change_log(stg_customers: DataFrame, load_ts: str) -> DataFrame:
    """Both extracts as one change log (state, change_ts)."""
    created = F.coalesce(F.col("created_at"), scd2.ts(scd2.DEFAULT_VALID_FROM))
    first = stg_customers.select(*scd2.SNAPSHOT_COLS, created.alias("change_ts"))
    return first.unionByName(second_extract(stg_customers).select(*scd2.SNAPSHOT_COLS, scd2.ts(load_ts).alias("change_ts")))


_SNAP = ", ".join(scd2.SNAPSHOT_COLS)
_HASH = ("md5(concat_ws('|', customer_name, coalesce(customer_class_id, ''), coalesce(salesperson_id, ''), "
         "coalesce(territory_id, ''), cast(credit_limit_amount as varchar)))")
_CHANGED = " or ".join(f"c.{c} is distinct from i.{c}" for c in scd2.CHECK_COLS)

SCD_CTES = f"""
b1 as (select * from stg_customers),
b2 as (
  select customer_id, customer_name,
    case when modified_at >= timestamp '{CLEAR_CLASS_MODIFIED[0]}' and modified_at < timestamp '{CLEAR_CLASS_MODIFIED[1]}'
         then null else customer_class_id end as customer_class_id,
    corporate_customer_id, primary_contact_person, address_line1,
    case when modified_at < timestamp '{UNTRACKED_MODIFIED_BEFORE}' then city || ' Norte' else city end as city,
    state, zip_code, country, phone_number_1, salesperson_id,
    case when modified_at >= timestamp '{MOVE_TERRITORY_MODIFIED_FROM}' then '{MOVED_TERRITORY}'
         else territory_id end as territory_id,
    payment_terms_id, credit_limit_amount, credit_limit_type, is_inactive, created_at, modified_at
  from stg_customers),
hist1 as (
  select {_SNAP},
    md5(concat(customer_id, '_', strftime(coalesce(created_at, timestamp '2000-01-01 00:00:00'), '%Y-%m-%d %H:%M:%S')))
      as customer_sk,
    coalesce(created_at, timestamp '2000-01-01 00:00:00') as valid_from,
    timestamp '9999-12-31 23:59:59' as valid_to, true as is_current, {_HASH} as row_hash
  from b1),
changed as (select c.customer_id from hist1 c join b2 i on c.customer_id = i.customer_id where {_CHANGED}),
hist2 as (
  select * from hist1 where customer_id not in (select customer_id from changed)
  union all
  select * replace (timestamp '{SCD2_LOAD_TS}' as valid_to, false as is_current)
  from hist1 where customer_id in (select customer_id from changed)
  union all
  select {_SNAP},
    md5(concat(customer_id, '_', strftime(timestamp '{SCD2_LOAD_TS}', '%Y-%m-%d %H:%M:%S'))) as customer_sk,
    timestamp '{SCD2_LOAD_TS}' as valid_from, timestamp '9999-12-31 23:59:59' as valid_to, true as is_current,
    {_HASH} as row_hash
  from b2 where customer_id in (select customer_id from changed)
     or customer_id not in (select customer_id from hist1))
"""


def _hist2(m):
    return scd2.scd2_apply(scd2.scd2_initial(m.stg_customers), second_extract(m.stg_customers), SCD2_LOAD_TS)


# ------------------------------------------------------------------ M13–M15
@register("scd2_initial", with_prelude(SCD_CTES, final=f"select {dbl('credit_limit_amount')} from hist1"))
def q_scd2_initial(spark, sf_dir):
    """First load of the customer history (first extract)."""
    return scd2.scd2_initial(mart_for(spark, sf_dir).stg_customers)


@register("scd2_apply", with_prelude(SCD_CTES, final=f"select {dbl('credit_limit_amount')} from hist2"))
def q_scd2_apply(spark, sf_dir):
    """Apply the second extract (check strategy)."""
    return _hist2(mart_for(spark, sf_dir))


@register("scd2_from_changes", with_prelude(SCD_CTES, final=f"select {dbl('credit_limit_amount')} from hist2"))
def q_scd2_from_changes(spark, sf_dir):
    """Chains from the change log of both extracts (equals M13 applied)."""
    m = mart_for(spark, sf_dir)
    return scd2.scd2_from_changes(change_log(m.stg_customers, SCD2_LOAD_TS))


@register("fact_sales_pit", with_prelude(ENRICHED, SCD_CTES, final="""
select e.invoice_number, e.line_item_sequence, e.component_sequence, e.customer_id, e.document_date,
  coalesce(h.customer_sk, md5('UNKNOWN_CUSTOMER')) as customer_sk
from enriched e left join hist2 h on e.customer_id = h.customer_id
  and cast(e.document_date as timestamp) >= h.valid_from and cast(e.document_date as timestamp) < h.valid_to"""))
def q_fact_sales_pit(spark, sf_dir):
    """Sales lines with the customer version valid at the document date."""
    m = mart_for(spark, sf_dir)
    lines = m.sales_lines_enriched.select("invoice_number", "line_item_sequence", "component_sequence",
                                          "customer_id", "document_date")
    return scd2.point_in_time(lines, _hist2(m))


# ------------------------------------------------------------------ quality
def _rule_sql(r: quality.Rule, table: str) -> str:
    head = (f"select {r.rule_id} as rule_id, '{r.table}' as table_name, '{r.kind}' as expectation, "
            f"'{r.column_text}' as columns, '{r.dimension}' as dimension")
    if r.kind == "row_count_between":
        cond = " and ".join([f"count(*) >= {r.params['min']}"] * ("min" in r.params) +
                            [f"count(*) <= {r.params['max']}"] * ("max" in r.params)) or "true"
        return f"{head}, count(*) as element_count, cast(0 as bigint) as unexpected_count, {cond} as success from {table}"
    if r.kind in ("unique", "compound_unique"):
        keys = ", ".join(r.columns)
        nn = " and ".join(f"{k} is not null" for k in r.columns)
        return (f"{head}, (select count(*) from {table}) as element_count, "
                f"cast(coalesce(sum(c) filter (where c > 1), 0) as bigint) as unexpected_count, "
                f"coalesce(sum(c) filter (where c > 1), 0) = 0 as success "
                f"from (select count(*) as c from {table} where {nn} group by {keys})")
    c = r.columns[0]
    if r.kind == "not_null":
        bad = f"{c} is null"
    elif r.kind == "in_set":
        vals = ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in r.params["values"])
        bad = f"{c} is not null and {c} not in ({vals})"
    else:
        lo, hi = r.params.get("min"), r.params.get("max")
        if isinstance(lo, str) or isinstance(hi, str):
            cc = f"cast({c} as date)"
            parts = ([f"{cc} < date '{lo}'"] if lo is not None else []) + ([f"{cc} > date '{hi}'"] if hi is not None else [])
        else:
            parts = ([f"{c} < {lo}"] if lo is not None else []) + ([f"{c} > {hi}"] if hi is not None else [])
        bad = f"{c} is not null and ({' or '.join(parts)})"
    return (f"{head}, count(*) as element_count, count(*) filter (where {bad}) as unexpected_count, "
            f"count(*) filter (where {bad}) = 0 as success from {table}")


def _rules_sql(rules, tables: dict[str, str]) -> str:
    body = "\nunion all ".join(f"({_rule_sql(r, tables[r.table])})" for r in rules)
    return f"select * from ({body}) order by table_name, rule_id"


# the header's own flag, looked up by document
SUITE_CTES = """sales_lines as (select e.*, h.VOIDSTTS as is_voided from enriched e join (
  select distinct SOPTYPE, rtrim(SOPNUMBE) as n, VOIDSTTS from SOP30200) h on h.SOPTYPE = e.sop_type and h.n = e.invoice_number)"""


def _suite_frames(m):
    """The suite's tables; lines and months come from one staged computation of the columns that they read."""
    lines = sales.sales_lines_enriched(m.stg_sales_headers, m.stg_sales_lines, ("is_voided",))
    read = {c for r in quality.SALES_SUITE if r.table == "sales_lines" for c in r.columns} | set(customers.MONTH_INPUTS)
    lines = stage(lines.select(*sorted(read)), "suite-lines")
    return {"sales_lines": lines, "customer_monthly": customers.customer_monthly(lines)}


@register("dq_expectations", with_prelude(ENRICHED, CUSTOMER_MONTHLY, SUITE_CTES, final=_rules_sql(
    quality.SALES_SUITE, {"sales_lines": "sales_lines", "customer_monthly": "customer_monthly"})))
def q_dq_expectations(spark, sf_dir):
    """The 11-rule expectation suite evaluated on the data."""
    return quality.evaluate(_suite_frames(mart_for(spark, sf_dir)), quality.SALES_SUITE)


@register("dq_suite_json", with_prelude(ENRICHED, SUITE_CTES, final=_rules_sql(
    [r for r in quality.SALES_SUITE if r.table == "sales_lines"], {"sales_lines": "sales_lines"})))
def q_dq_suite_json(spark, sf_dir):
    """The suite of the sales lines, read from its JSON file."""
    text = (Path(__file__).parent / "suites" / "sales_lines.json").read_text(encoding="utf-8")
    return quality.evaluate(_suite_frames(mart_for(spark, sf_dir)), quality.load_suite(text, "sales_lines"))


@register("dq_by_dimension", with_prelude(ENRICHED, CUSTOMER_MONTHLY, SUITE_CTES, final=f"""
select dimension, count(*) as rules, count(*) filter (where success) as passed,
  count(*) filter (where not success) as failed, cast(sum(unexpected_count) as bigint) as unexpected_rows
from ({_rules_sql(quality.SALES_SUITE, {"sales_lines": "sales_lines", "customer_monthly": "customer_monthly"})})
group by 1 order by 1"""))
def q_dq_by_dimension(spark, sf_dir):
    """Suite roll-up per quality dimension."""
    return quality.by_dimension(quality.evaluate(_suite_frames(mart_for(spark, sf_dir)), quality.SALES_SUITE))


DIM_DATE_CTE = CALENDAR + """, dim_date_d as (select cast(strftime(d, '%Y%m%d') as integer) as date_sk from calendar)"""
SNAPSHOT_CTE = """
snapshot_f as (
  select md5(concat(customer_id, '_', cast(year_month_sk as varchar))) as snapshot_sk, customer_id, year_month_sk
  from customer_monthly)
"""
COLUMN_TEST_TABLES = {
    "stg_customers": "stg_customers", "stg_sales_headers": "stg_sales_headers", "stg_sales_lines": "stg_sales_lines",
    "stg_items": "stg_items", "sales_lines_enriched": "enriched", "customer_orders_summary": "summary",
    "customer_monthly": "customer_monthly", "dim_customer": "dim_customer", "dim_product": "dim_product",
    "dim_date": "dim_date_d", "fact_sales": "fact_sales", "fact_customer_monthly_snapshot": "snapshot_f",
}


def _column_test_frames(m):
    """The tested tables; lines and the sales fact are computed once, the fact without untested columns."""
    m = m.staged("sales_lines_enriched")
    tested = sorted({c for table, c, _ in quality.COLUMN_TESTS if table == "fact_sales"})
    m.__dict__["fact_sales"] = stage(m.fact_sales.select(*tested), "fact_sales")
    return {name: getattr(m, _TABLE_FRAMES.get(name, name)) for name in COLUMN_TEST_TABLES}


_TABLE_FRAMES = {"customer_orders_summary": "customer_summary"}


@register("dq_column_tests", with_prelude(ENRICHED, CUSTOMER_SUMMARY, CUSTOMER_MONTHLY, DIMS, FACT_SALES_SQL,
                                          DIM_DATE_CTE, SNAPSHOT_CTE,
                                          final=_rules_sql(quality.column_test_rules(), COLUMN_TEST_TABLES)))
def q_dq_column_tests(spark, sf_dir):
    """The declared not_null / unique / accepted_values column tests."""
    return quality.evaluate(_column_test_frames(mart_for(spark, sf_dir)), quality.column_test_rules())


# fact -> (foreign key, dimension frame of the mart, its key)
_KEYS = {
    "fact_sales": (("customer_sk", "customers", "customer_sk"), ("product_sk", "products", "product_sk"),
                   ("salesperson_sk", "salespeople", "salesperson_sk"), ("territory_sk", "territories", "territory_sk"),
                   ("document_date_sk", "dates", "date_sk"), ("gl_post_date_sk", "dates", "date_sk")),
    "fact_customer_monthly_snapshot": (
        ("year_month_sk", "dates", "date_sk"), ("customer_sk", "customers", "customer_sk"),
        ("salesperson_sk", "salespeople", "salesperson_sk"), ("territory_sk", "territories", "territory_sk")),
    "fact_receivables_open": (
        ("doc_date_sk", "dates", "date_sk"), ("due_date_sk", "dates", "date_sk"),
        ("customer_sk", "customers", "customer_sk"), ("salesperson_sk", "salespeople", "salesperson_sk"),
        ("territory_sk", "territories", "territory_sk")),
    "fact_inventory_balance": (("date_sk", "dates", "date_sk"), ("product_sk", "products", "product_sk"),
                               ("location_sk", "locations", "location_sk")),
    "fact_inventory_transactions": (
        ("trx_date_sk", "dates", "date_sk"), ("product_sk", "products", "product_sk"),
        ("from_location_sk", "locations", "location_sk"), ("to_location_sk", "locations", "location_sk")),
}


def _referential_oracle() -> str:
    """Expected answer from the sources: every fact has its rows, and no key is an orphan."""
    sizes = {
        "fact_sales": "select count(*) from enriched",
        "fact_customer_monthly_snapshot":
            "select count(*) from (select distinct customer_id, date_trunc('month', document_date) from enriched)",
        "fact_receivables_open": "select count(*) from stg_open_ar",
        "fact_inventory_balance": "select 3 * count(*) from part",
        "fact_inventory_transactions": "select count(*) from lineitem",
    }
    rows = " union all ".join(
        f"select '{t}' as table_name, '{fk}' as foreign_key, ({sizes[t]}) as fact_rows, cast(0 as bigint) as orphan_rows,"
        f" true as success" for t, keys in _KEYS.items() for fk, *_ in keys)
    return f"select * from ({rows})"


@register("dq_referential", with_prelude(ENRICHED, final=_referential_oracle()))
def q_dq_referential(spark, sf_dir):
    """Orphan foreign keys of every fact."""
    m = mart_for(spark, sf_dir).staged("sales_lines_enriched")
    members = {
        "customers": dims.dim_customer_members(m.dim_customer),
        "products": dims.add_member(m.dim_product, "product_sk", "item_number", L.UNKNOWN_PRODUCT),
        "salespeople": dims.add_member(m.dim_salesperson, "salesperson_sk", "salesperson_id", L.UNKNOWN_SP),
        "territories": dims.add_member(m.dim_territory, "territory_sk", "territory_id", L.UNKNOWN_TERR),
        "dates": m.dim_date, "locations": m.dim_location,
    }
    frames = {
        "fact_sales": m.fact_sales, "fact_customer_monthly_snapshot": m.fact_customer_monthly_snapshot,
        "fact_receivables_open": facts.fact_receivables_open(
            m.stg_open_ar, m.dim_customer, m.dim_salesperson, m.dim_territory, m.latest_rate, m.as_of),
        "fact_inventory_balance": facts.fact_inventory_balance(
            m.stg_item_quantities, m.inventory_valuation, inventory.latest_model_rate(m.stg_fx), m.as_of),
        "fact_inventory_transactions": facts.fact_inventory_transactions(m.stg_inventory_transactions, m.rates),
    }
    return quality.referential({t: (frames[t], {fk: (members[d], pk) for fk, d, pk in keys})
                                for t, keys in _KEYS.items()})


@register("quarantine_split", with_prelude(ENRICHED, final=f"""
select {dbl('direction_multiplier', 'net_quantity', 'unit_price', 'gross_sales_amount', 'unit_cost',
            'total_cost_amount', 'markdown_amount', 'net_sales_amount', 'gross_profit_amount')}
from (select e.*,
        case when c.customer_id is null then 'UNKNOWN_CUSTOMER'
             when e.net_sales_amount is null then 'NULL_AMOUNT' end as quarantine_reason
      from enriched e left join (select distinct customer_id from stg_customers) c on e.customer_id = c.customer_id)"""))
def q_quarantine_split(spark, sf_dir):
    """Every sales line with its quarantine reason (NULL = clean)."""
    m = mart_for(spark, sf_dir)
    headers = quality.known_customers(m.stg_sales_headers, m.stg_customers)
    lines = sales.sales_lines_enriched(headers, m.stg_sales_lines, ("_known",))
    return quality.quarantine(lines, m.stg_customers)


@register("dq_incremental", with_prelude(ENRICHED, DIMS, FACT_SALES_SQL, final=_rules_sql(
    quality.CONTRACT_RULES, {"fact_sales": "fact_sales"})))
def q_dq_incremental(spark, sf_dir):
    """G06 from mergeable states: the months before 1999 are checked first, then only the later ones are read."""
    import uuid

    from ..session import checkpoint_dir
    from ..sources.parts import PartStore
    from ..streaming.quality_state import QualityState
    base = f"{checkpoint_dir(spark).rstrip('/')}/quality-{uuid.uuid4().hex}"
    month = F.coalesce((F.col("document_date_sk") / 100).cast("int"), F.lit(0)).cast("string")
    read = {c for r in quality.CONTRACT_RULES for c in r.columns} | {"document_date_sk"}
    fact = stage(mart_for(spark, sf_dir).fact_sales.select(*sorted(read), month.alias("part")), "fact_sales")
    source = PartStore(spark, f"{base}/fact")
    state = QualityState(source, "fact_sales", month, quality.CONTRACT_RULES, f"{base}/state", buckets=8)
    early = "document_date_sk < 19990101"
    for rows, last in ((early, False), (f"not ({early}) or document_date_sk is null", True)):
        change = source.change()
        change.append("fact_sales", fact.where(rows))
        change.publish()
        if last:
            discard(fact)
        state.run()
    return state.results()


# What the first delivery lacks: amounts of the documents of every 101st order, customers by the end of their number.
_DAMAGED = "substr(invoice_number, 4)::bigint % 101 = 0"
_LATE = "customer_id like '%7'"


@register("quarantine_replay", with_prelude(ENRICHED, final=f"""
, judged as (
  select customer_id in (select customer_id from stg_customers) as known, {_LATE} as late, {_DAMAGED} as damaged from enriched)
select 'delivered' as step, count(*) filter (known and not late and not damaged) as clean_rows,
  count(*) filter (not known or late) as unknown_customer_rows,
  count(*) filter (known and not late and damaged) as null_amount_rows from judged
union all
select 'corrected', count(*) filter (known and not late), count(*) filter (not known or late), 0 from judged
union all select 'customers arrived', count(*) filter (known), count(*) filter (not known), 0 from judged
union all select 'customers registered', count(*), 0, 0 from judged"""))
def q_quarantine_replay(spark, sf_dir):
    """Lines delivered with missing amounts and customers, corrected, and replayed until nothing is rejected."""
    import uuid

    from ..session import checkpoint_dir
    from ..streaming.quarantine import Quarantine
    m = mart_for(spark, sf_dir)
    lines = stage(m.sales_lines_enriched.select("invoice_number", "line_item_sequence", "component_sequence", "customer_id",
                                                "net_sales_amount"), "quarantine-lines")
    damaged = F.substring("invoice_number", 4, 20).cast("long") % 101 == 0
    q = Quarantine(spark, f"{checkpoint_dir(spark).rstrip('/')}/quarantine-{uuid.uuid4().hex}", buckets=8)
    known = m.stg_customers.select("customer_id")
    present = known.where(~F.col("customer_id").like("%7"))
    steps = []

    def step(name):
        steps.append(q.counts().select(F.lit(name).alias("step"), "*"))

    q.load(lines.withColumn("net_sales_amount", F.when(~damaged, F.col("net_sales_amount"))), present)
    step("delivered")
    q.load(lines.where(damaged), present)
    step("corrected")
    q.replay(known)
    step("customers arrived")
    q.replay(known.unionByName(m.stg_sales_headers.select("customer_id")).distinct())
    step("customers registered")
    return reduce(DataFrame.unionByName, steps)


@register("dq_contract", with_prelude(ENRICHED, DIMS, FACT_SALES_SQL, final=_rules_sql(
    quality.CONTRACT_RULES, {"fact_sales": "fact_sales"}).replace(
    "select * from (", "select * from (select 0 as rule_id, 'fact_sales' as table_name, 'schema_columns' as expectation, "
    "'component_sequence,customer_sk,document_date_sk,invoice_number,line_item_sequence,net_sales_amount,product_sk,"
    "sales_fact_sk' as columns, 'Consistency' as dimension, cast(8 as bigint) as element_count, "
    "cast(0 as bigint) as unexpected_count, true as success union all ", 1).replace(
    "order by table_name, rule_id", "order by rule_id")))
def q_dq_contract(spark, sf_dir):
    """Data contract of the sales fact (+ schema check)."""
    fact = mart_for(spark, sf_dir).fact_sales
    read = {c for r in quality.CONTRACT_RULES for c in r.columns}
    return quality.contract(stage(fact.select(*[c for c in fact.columns if c in read]), "fact_sales"))


@register("dq_freshness", with_prelude(ENRICHED, final=f"""
select 'fact_sales' as table_name, max(document_date) as max_date, {AS_OF_SQL} as as_of,
  cast(datediff('day', max(document_date), {AS_OF_SQL}) as integer) as lag_days, 1 as sla_days,
  datediff('day', max(document_date), {AS_OF_SQL}) <= 1 as is_fresh
from enriched"""))
def q_dq_freshness(spark, sf_dir):
    """Freshness of the sales fact against the daily SLA."""
    m = mart_for(spark, sf_dir)
    return quality.freshness(m.sales_lines_enriched, "document_date", m.as_of, "fact_sales")


# ------------------------------------------------------------------ privacy
_MASK_NAME = ("case when {c} is null then null when regexp_extract({c}, '^(\\S+\\s+\\S)', 1) <> '' "
              "then regexp_extract({c}, '^(\\S+\\s+\\S)', 1) || '***' else substring({c}, 1, 1) || '***' end")
_MASK_PHONE = ("case when length({c}) > 4 then regexp_replace(substring({c}, 1, length({c}) - 4), '[0-9]', '*', 'g') "
               "|| right({c}, 4) else regexp_replace({c}, '[0-9]', '*', 'g') end")


@register("customer_masked", with_prelude(final=f"""
select customer_id, {_MASK_NAME.format(c='customer_name')} as customer_name,
  sha256(primary_contact_person) as primary_contact_hash,
  {_MASK_PHONE.format(c='phone_number_1')} as phone_number_1, {_MASK_PHONE.format(c='phone_number_2')} as phone_number_2,
  regexp_replace(fax_number, '[0-9]', '*', 'g') as fax_number, city, state, country, customer_class_id,
  salesperson_id, territory_id
from stg_customers"""))
def q_customer_masked(spark, sf_dir):
    """Masked customer master."""
    return privacy.customer_masked(mart_for(spark, sf_dir).stg_customers)


ROLE_TERRITORY = "NATION_7"


@register("role_view_sales", with_prelude(FACT_USD, final=f"""
select * exclude (quantity), quantity from fact_usd where territory_name = '{ROLE_TERRITORY}'"""))
def q_role_view_sales(spark, sf_dir):
    """Sales-executive view (own territory, full rows)."""
    from .q_sales import FACT_USD_COLS
    f = privacy.role_view_sales(mart_for(spark, sf_dir).fact_usd, ROLE_TERRITORY)
    return f.select(*[c.strip() for c in FACT_USD_COLS.split(",")])


@register("role_view_analyst", with_prelude(FACT_USD, SVC_CUSTOMERS, final=f"""
, t as (select customer_id, cast(sum(cast(net_sales_amount as decimal(30,2))) as double) as net_sales,
          cast(sum(cast(gross_profit_amount as decimal(30,2))) as double) as gross_profit,
          count(distinct invoice_number) as orders from fact_usd group by 1)
select c.customer_id, {_MASK_NAME.format(c='c.customer_name')} as customer_name, c.customer_class_id,
  c.territory_name, {_MASK_PHONE.format(c='c.phone')} as phone, t.net_sales, t.gross_profit, t.orders
from svc_customers c left join t on c.customer_id = t.customer_id"""))
def q_role_view_analyst(spark, sf_dir):
    """BI-analyst view (masked identity, full metrics)."""
    m = mart_for(spark, sf_dir)
    return privacy.role_view_analyst(m.fact_usd, m.service_customers)


@register("role_view_scientist", with_prelude(ENRICHED, CUSTOMER_MONTHLY, final="""
select sha256(customer_id) as customer_token, year_month_sk, active_month_flag, is_churned_flag, is_new_customer_flag,
  cast(net_sales_month as double) as net_sales_month, cast(gross_profit_month as double) as gross_profit_month,
  cast(cumulative_net_sales_ltv as double) as cumulative_net_sales_ltv,
  cast(cumulative_gross_profit_ltv as double) as cumulative_gross_profit_ltv,
  days_since_last_purchase_at_month_end as days_since_last_purchase
from customer_monthly"""))
def q_role_view_scientist(spark, sf_dir):
    """Data-scientist view (tokenised customer, monthly facts)."""
    m = mart_for(spark, sf_dir)
    return privacy.role_view_scientist(m.fact_customer_monthly_snapshot)


# Fixed value: territory of the sales executive's customers.
ROLE_TERRITORY_ID = "7"


@register("role_customers_sales", with_prelude(DIMS, final=f"""
select {dbl('credit_limit_amount')} from dim_customer where territory_id = '{ROLE_TERRITORY_ID}'"""))
def q_role_customers_sales(spark, sf_dir):
    """Sales executive on the customer dimension."""
    return privacy.role_customers_sales(mart_for(spark, sf_dir).dim_customer, ROLE_TERRITORY_ID)


@register("role_customers_analyst", with_prelude(DIMS, final=f"""
select customer_sk, customer_id, {_MASK_NAME.format(c='customer_name')} as customer_name, customer_class_id,
  customer_class_desc, sha256(primary_contact) as primary_contact_hash, city, country,
  {_MASK_PHONE.format(c='phone_number')} as phone_number, salesperson_id, territory_id from dim_customer"""))
def q_role_customers_analyst(spark, sf_dir):
    """BI analyst on the customer dimension (masked)."""
    return privacy.role_customers_analyst(mart_for(spark, sf_dir).dim_customer)


@register("role_customers_scientist", with_prelude(DIMS, final="""
select sha256(customer_id) as customer_token, customer_class_id, country, territory_id, is_inactive_source from dim_customer"""))
def q_role_customers_scientist(spark, sf_dir):
    """Data scientist on the customer dimension (tokens)."""
    return privacy.role_customers_scientist(mart_for(spark, sf_dir).dim_customer)


@register("role_fact_scientist", with_prelude(ENRICHED, DIMS, FACT_SALES_SQL, final=f"""
select {dbl('quantity', 'net_sales_amount', 'gross_profit_amount')} from (
  select document_date_sk // 100 as year_month, product_sk, territory_sk, sum(quantity) as quantity,
    sum(net_sales_amount) as net_sales_amount, sum(gross_profit_amount) as gross_profit_amount, count(*) as n_lines
  from fact_sales group by all)"""))
def q_role_fact_scientist(spark, sf_dir):
    """Data scientist on the sales fact (aggregated)."""
    return privacy.role_fact_scientist(mart_for(spark, sf_dir).fact_sales)


@register("role_view_auditor", with_prelude(final="""
select h.invoice_number, h.sop_type, h.customer_id, h.document_date, cast(h.subtotal as double) as header_subtotal,
  cast(coalesce(l.s, 0) as double) as lines_total, cast(h.subtotal - coalesce(l.s, 0) as double) as difference,
  h.subtotal = coalesce(l.s, 0) as reconciled
from (select SOPTYPE as sop_type, rtrim(SOPNUMBE) as invoice_number, rtrim(CUSTNMBR) as customer_id,
        cast(DOCDATE as date) as document_date, SUBTOTAL as subtotal, trim(SOPNUMBE) as k from SOP30200
      where VOIDSTTS = 0) h
left join (select SOPTYPE, trim(SOPNUMBE) as k, sum(XTNDPRCE) as s from SOP30300 group by 1, 2) l
  on l.SOPTYPE = h.sop_type and l.k = h.k"""))
def q_role_view_auditor(spark, sf_dir):
    """Financial-auditor view, every document reconciled with its source lines."""
    src = mart_for(spark, sf_dir).src
    return privacy.role_view_auditor(src["SOP30200"], src["SOP30300"])


# ------------------------------------------------------------------ S10, S12
def _refresh_marts(m):
    """Every mart; the lines and the USD fact are computed once and read by all."""
    m = m.staged("sales_lines_enriched", "fact_usd")
    names = ("dim_customer", "dim_product", "dim_salesperson", "dim_territory", "fact_sales",
             "fact_customer_monthly_snapshot", "inventory_valuation", "inventory_items", "ar_documents")
    return {**{n: getattr(m, n) for n in names}, "customer_orders_summary": m.customer_summary,
            "fact_sales_usd": m.fact_usd}


@register("refresh_counts", with_prelude(ENRICHED, FACT_USD, DIMS, FACT_SALES_SQL, CUSTOMER_SUMMARY, CUSTOMER_MONTHLY,
                                         MODEL_INV, final="""
, svc_fx as (select arg_max(xchg_rate, exch_date) as r from fx_rates),
svc_items as (select count(*) as n from IV00102 s join IV00101 i on trim(s.ITEMNMBR) = trim(i.ITEMNMBR)
              where s.RCRDTYPE = 1)
select * from (
  select 'dim_customer' as mart, count(*) as row_count from dim_customer
  union all select 'dim_product', count(*) from dim_product
  union all select 'dim_salesperson', count(*) from dim_salesperson
  union all select 'dim_territory', count(*) from dim_territory
  union all select 'fact_sales', count(*) from fact_sales
  union all select 'fact_customer_monthly_snapshot', count(*) from customer_monthly
  union all select 'customer_orders_summary', count(*) from summary
  union all select 'inventory_valuation', count(*) from inventory_valuation
  union all select 'fact_sales_usd', count(*) from fact_usd
  union all select 'inventory_items', (select n from svc_items)
  union all select 'ar_documents', count(*) from RM20101 where CURTRXAM > 0 and VOIDSTTS = 0)"""))
def q_refresh_counts(spark, sf_dir):
    """Full refresh row counts of every mart."""
    from ..streaming.refresh import refresh_counts
    return refresh_counts(_refresh_marts(mart_for(spark, sf_dir)))


_MONTHLY_OUT = ("customer_id", "period_month", "year_month_sk", "cohort_month", "first_purchase_date",
                "total_invoices_month", "total_returns_month", "gross_sales_month", "returns_amount_month",
                "net_sales_month", "total_cogs_month", "gross_profit_month", "cumulative_net_sales_ltv",
                "cumulative_gross_profit_ltv", "cumulative_last_purchase_date", "days_since_last_purchase_at_month_end",
                "active_month_flag", "is_new_customer_flag", "is_churned_flag")


@register("incremental_equals_batch", with_prelude(ENRICHED, CUSTOMER_MONTHLY, final=f"""
select {dbl('gross_sales_month', 'returns_amount_month', 'net_sales_month', 'total_cogs_month', 'gross_profit_month',
            'cumulative_net_sales_ltv', 'cumulative_gross_profit_ltv')} from customer_monthly"""))
def q_incremental_equals_batch(spark, sf_dir):
    """Customer-month history maintained by streaming refreshes."""
    return _incremental(spark, sf_dir).history().select(*_MONTHLY_OUT)


def _incremental(spark, sf_dir):
    """The marts after four landings (invoices before 1999, invoices from 1999, the same file again, then all
    returns late) and the arrival of the customers that were missing at first."""
    import uuid

    from ..session import checkpoint_dir
    from ..streaming.incremental import IncrementalMarts
    m = mart_for(spark, sf_dir).staged("sales_lines_enriched")
    late = F.crc32("customer_id") % 3 == 0
    present = {"customer": m.dim_customer.where(~late), "product": m.dim_product, "salesperson": m.dim_salesperson,
               "territory": m.dim_territory}
    inc = IncrementalMarts(spark, f"{checkpoint_dir(spark).rstrip('/')}/incremental-{uuid.uuid4().hex}", lambda: present,
                           buckets=2)
    lines = m.sales_lines_enriched
    cut = F.lit("1999-01-01").cast("date")
    recent = lines.where((F.col("sop_type") == 3) & (F.col("document_date") >= cut))
    for chunk in (lines.where((F.col("sop_type") == 3) & (F.col("document_date") < cut)), recent, recent,
                  lines.where(F.col("sop_type") != 3)):
        inc.land(chunk)
        inc.run(lines.schema)
    discard(lines)
    present["customer"] = m.dim_customer
    inc.dimensions_changed()
    return inc


@register("incremental_fact_sales", ORACLES["fact_sales"])
def q_incremental_fact_sales(spark, sf_dir):
    """Sales fact after redelivered lines and late customers."""
    return _incremental(spark, sf_dir).fact()


@register("incremental_snapshot", ORACLES["fact_customer_monthly_snapshot"])
def q_incremental_snapshot(spark, sf_dir):
    """Customer-month snapshot after redelivered lines and late customers."""
    return _incremental(spark, sf_dir).snapshot()
