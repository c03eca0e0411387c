"""Binding of the driver's TPC-H-ish tables to the ERP source schemas.

The marts read thirteen ERP tables (customers, classes, salespeople,
territories, sales headers and lines, items, item quantities, purchase layers,
inventory transactions, locations, open receivables and exchange rates).  The
test data has none of them, so each one is derived from the driver tables by a
fixed, portable SQL block (FIXTURES.md §2).  The same text runs in Spark SQL and
in DuckDB; only the ``seq`` helper differs.

In Spark the blocks run through ``spark.sql(text, **frames)`` so no global temp
view names are taken; every source is a lazy DataFrame over the parquet scans,
so Catalyst prunes columns and pushes filters into the driver files.

In production the same source frames come from ``sources.readers`` (parquet
exports or partitioned JDBC reads) instead of this module.
"""

from __future__ import annotations

import threading

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.ranking import bucketed_row_number, clustered_row_number
from ..session import session_key
from .extracts import typed
from .io import read_source

DRIVER_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")

# The binding blocks of FIXTURES.md §2 (table placeholders in braces).
SOURCE_SQL: dict[str, str] = {
    "RM00303": """
select rpad(cast(n_nationkey as string), 10, ' ') as SALSTERR, n_name || '  ' as SLTERDSC,
  case when n_nationkey % 5 = 0 then '' else '000' || cast(n_nationkey % 10 as string) end as SLPRSNID,
  'Mgr' || cast(n_nationkey as string) as STMGRFNM,
  case when n_nationkey % 4 = 0 then null else 'Region' || cast(n_regionkey as string) end as STMGRLNM,
  'XX ' as COUNTRY, case when n_nationkey % 9 = 8 then 1 else 0 end as INACTIVE
from {nation}""",
    "RM00301": """
select '000' || cast(s_suppkey as string) || '   ' as SLPRSNID, 'E' || cast(s_suppkey as string) as EMPLOYID, '' as VENDORID,
  'First' || cast(s_suppkey as string) as SLPRSNFN, '' as SPRSNSMN,
  case when s_suppkey = 7 then null else 'Last' || cast(s_suppkey as string) end as SPRSNSLN, 'Rep ' as SPRNSTTL,
  case when s_suppkey = 3 then '' else cast(s_nationkey as string) end as SALSTERR,
  cast(s_suppkey as decimal(8,4)) as COMPRCNT, case when s_suppkey = 9 then 1 else 0 end as INACTIVE
from {supplier}""",
    "RM00201": """
select distinct c_mktsegment || ' ' as CLASSID, 'Class ' || lower(c_mktsegment) as CLASDSCR, 1 as CRLMTTYP,
  cast(5000 as decimal(19,2)) as CRLMTAMT, '' as CHEKBKID, 'NET30' as PYMTRMID, 'STD' as PRCLEVEL
from {customer}""",
    "RM00101": """
select 'C' || lpad(cast(c_custkey as string), 8, '0') || '  ' as CUSTNMBR, c_name as CUSTNAME,
  case when c_custkey % 13 = 0 then ' ' else c_mktsegment || '  ' end as CUSTCLAS, '' as CPRCSTNM,
  'Contact ' || cast(c_custkey as string) as CNTCPRSN, c_name as STMTNAME, '' as SHRTNAME,
  cast(c_custkey as string) || ' Main St' as ADDRESS1, '' as ADDRESS2, 'City' || cast(c_custkey % 40 as string) as CITY,
  '' as STATE, '' as ZIP, 'XX' as COUNTRY, '+1-555-' || lpad(cast(c_custkey as string), 7, '0') as PHONE1, '' as PHONE2, '' as FAX,
  case when c_custkey % 7 = 0 then '' else '000' || cast(c_custkey % 10 as string) end as SLPRSNID,
  case when c_custkey % 11 = 0 then '' else cast(c_nationkey as string) end as SALSTERR, 'NET30' as PYMTRMID, 'CHK' as CHEKBKID,
  2 as CRLMTTYP, cast(case when c_acctbal < 0 then 0 else c_acctbal * 20 end as decimal(19,2)) as CRLMTAMT,
  cast(c_custkey % 15 as decimal(8,4)) as CUSTDISC, case when c_custkey % 50 = 49 then 1 else 0 end as INACTIVE,
  cast(date '1994-01-01' + cast(c_custkey % 300 as int) as timestamp) as CREATDDT,
  cast(date '1995-01-01' + cast(c_custkey % 900 as int) as timestamp) as MODIFDT
from {customer}""",
    "IV00101": """
select 'P' || lpad(cast(p_partkey as string), 8, '0') as ITEMNMBR, p_name as ITEMDESC,
  case when p_type = 'ECONOMY' then 'MP' when p_type = 'PROMO' then 'ME ' when p_partkey % 17 = 0 then '' else p_type end as ITMCLSCD,
  p_brand as ITMGEDSC, cast(p_retailprice * 0.5 as decimal(19,4)) as STNDCOST,
  case when p_partkey % 10 = 0 then cast(0 as decimal(19,4)) else cast(p_retailprice * 0.6 as decimal(19,4)) end as CURRCOST,
  'UN' as UOMSCHDL, 2 as DECPLQTY, 2 as DECPLCUR, 1 as ITEMTRKOP, case when p_size = 50 then 1 else 0 end as INACTIVE
from {part}""",
    "SOP30300": """
select case when l_returnflag = 'R' then 4 else 3 end as SOPTYPE,
  case when l_returnflag = 'R' then 'RTN' else 'INV' end || lpad(cast(l_orderkey as string), 10, '0') as SOPNUMBE,
  l_linenumber as LNITMSEQ,
  cast(row_number() over (partition by l_orderkey, l_returnflag = 'R', l_linenumber
    order by l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_shipdate) - 1 as int) as CMPNTSEQ,
  'P' || lpad(cast(l_partkey as string), 8, '0') as ITEMNMBR, p_name as ITEMDESC, 'UN ' as UOFM,
  'ALM-0' || cast(l_suppkey % 3 + 1 as string) as LOCNCODE, cast(o_orderdate as date) as DOCDATE,
  case when o_orderkey % 211 = 0 then 'X' else 'C' end || lpad(cast(o_custkey as string), 8, '0') as CUSTNMBR, cast(l_quantity as decimal(19,4)) as QUANTITY,
  cast(floor(l_extendedprice / l_quantity) as decimal(19,4)) as UNITPRCE, cast(l_extendedprice as decimal(19,2)) as XTNDPRCE,
  cast(p_retailprice * 0.6 as decimal(19,4)) as UNITCOST,
  cast(cast(l_extendedprice as decimal(19,2)) * (cast(50 + l_partkey % 30 as decimal(6,2)) * cast(0.01 as decimal(4,2))) as decimal(19,2)) as EXTDCOST,
  cast(cast(l_extendedprice as decimal(19,2)) * cast(l_discount as decimal(4,2)) as decimal(19,2)) as MRKDNAMT,
  case when l_orderkey % 6 = 0 then cast(l_extendedprice as decimal(19,2)) else cast(0 as decimal(19,2)) end as OXTNDPRC
from {lineitem} join {orders} on l_orderkey = o_orderkey join {part} on l_partkey = p_partkey""",
    "SOP30200": """
select d.SOPTYPE, d.SOPNUMBE, case when d.SOPTYPE = 4 then 'DEV' else 'FAC' end as DOCID, cast(o_orderdate as date) as DOCDATE,
  cast(o_orderdate as date) + cast(o_orderkey % 4 as int) as GLPOSTDT,
  case when o_orderkey % 211 = 0 then 'X' else 'C' end || lpad(cast(o_custkey as string), 8, '0') as CUSTNMBR,
  c_name as CUSTNAME, case when o_orderkey % 8 = 0 then '' else '000' || cast(d.SUPPKEY as string) end as SLPRSNID,
  case when o_orderkey % 9 = 0 then '' else cast(c_nationkey as string) end as SALSTERR,
  case when o_orderkey % 6 = 0 then 'USD  ' else 'VEF' end as CURNCYID, 'NET30' as PYMTRMID,
  d.SUBTOTAL, d.SUBTOTAL as DOCAMNT, cast(0 as decimal(19,2)) as FRTAMNT, cast(0 as decimal(19,2)) as MISCAMNT, cast(0 as decimal(19,2)) as TAXAMNT,
  cast(0 as decimal(19,2)) as TRDISAMT, cast(0 as decimal(19,2)) as DISCDLND,
  case when o_orderkey % 50 = 0 then 1 else 0 end as VOIDSTTS,
  case when o_orderkey % 4 = 0 then cast(5.25 as decimal(19,7)) else cast(0 as decimal(19,7)) end as XCHGRATE
from (select l_orderkey, case when l_returnflag = 'R' then 4 else 3 end as SOPTYPE,
        case when l_returnflag = 'R' then 'RTN' else 'INV' end || lpad(cast(l_orderkey as string), 10, '0') as SOPNUMBE,
        cast(sum(cast(l_extendedprice as decimal(19,2))) as decimal(19,2)) as SUBTOTAL, min(l_suppkey) as SUPPKEY
      from {lineitem} group by 1, 2, 3) d
join {orders} on d.l_orderkey = o_orderkey join {customer} on o_custkey = c_custkey""",
    "MC00100": """
select case when i % 10 = 9 then 'USD-COMPRAS' else 'USD-VENTAS ' end as EXGTBLID, 'USD' as CURNCYID,
  week as EXCHDATE,
  case when i % 25 = 24 then cast(0 as decimal(19,7)) else cast(cast(4 as decimal(10,2)) + cast(i as decimal(10,0)) * cast(0.01 as decimal(4,2)) as decimal(19,7)) end as XCHGRATE,
  date '2099-12-31' as EXPNDATE
from (select week, row_number() over (order by week) - 1 as i
      from (select distinct cast(date_trunc('week', o_orderdate) as date) as week from {orders}))""",
    "IV40700": """
select distinct 'ALM-0' || cast(s_suppkey % 3 + 1 as string) || '  ' as LOCNCODE,
  case when s_suppkey % 3 = 2 then '' else 'Warehouse ' || cast(s_suppkey % 3 + 1 as string) end as LOCNDSCR
from {supplier}""",
    "IV00102": """
select 'P' || lpad(cast(p_partkey as string), 8, '0') || ' ' as ITEMNMBR,
  case when k = 0 then '' else 'ALM-0' || cast(k as string) end as LOCNCODE, case when k = 0 then 1 else 2 end as RCRDTYPE,
  cast(case when k = 0 then (p_partkey*37+91) % 45 + (p_partkey*37+182) % 45 + (p_partkey*37+273) % 45 else (p_partkey*37+k*91) % 45 end as decimal(19,4)) as QTYONHND,
  cast(case when k = 0 then (p_partkey*13+7) % 18 + (p_partkey*13+14) % 18 + (p_partkey*13+21) % 18 else (p_partkey*13+k*7) % 18 end as decimal(19,4)) as ATYALLOC,
  cast(p_partkey % 30 as decimal(19,4)) as QTYONORD, cast(0 as decimal(19,4)) as QTYBKORD,
  cast(10 + p_partkey % 20 as decimal(19,4)) as SFTYSTCKQTY, cast(20 + p_partkey % 20 as decimal(19,4)) as ORDRPNTQTY,
  cast(1 as decimal(19,4)) as MNMMORDRQTY, cast(500 as decimal(19,4)) as MXMMORDRQTY
from {part} cross join (select i as k from {seq}) ks""",
    "IV10200": """
select 'P' || lpad(cast(l_partkey as string), 8, '0') as ITEMNMBR,
  case when l_suppkey % 4 = 0 then '' else 'ALM-0' || cast(l_suppkey % 3 + 1 as string) end as TRXLOCTN,
  cast(l_shipdate as date) as DATERECD,
  cast(row_number() over (partition by l_partkey order by l_shipdate, l_orderkey, l_linenumber, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax) as int) as RCTSEQNM,
  cast(l_quantity as decimal(19,4)) as QTYRECVD,
  cast(case when l_linestatus = 'F' then l_quantity else l_quantity - (l_orderkey % 3) end as decimal(19,4)) as QTYSOLD,
  cast(floor(l_extendedprice / l_quantity) as decimal(19,4)) as UNITCOST,
  'RCP' || lpad(cast(l_orderkey as string), 10, '0') as RCPTNMBR, 'V' || cast(l_suppkey as string) as VENDORID
from {lineitem}""",
    "IV30300": """
select cast(l_linenumber % 7 + 1 as int) as DOCTYPE, 'TRX' || lpad(cast(l_orderkey as string), 10, '0') as DOCNUMBR,
  cast(l_shipdate as date) as DOCDATE, 'P' || lpad(cast(l_partkey as string), 8, '0') as ITEMNMBR,
  case when l_suppkey % 4 = 0 then ' ' else 'ALM-0' || cast(l_suppkey % 3 + 1 as string) end as TRXLOCTN,
  case when l_linenumber % 7 = 2 then 'ALM-0' || cast((l_suppkey + 1) % 3 + 1 as string) else '' end as TRNSTLOC,
  cast(l_quantity as decimal(19,4)) as TRXQTY, cast(floor(l_extendedprice / l_quantity) as decimal(19,4)) as UNITCOST,
  cast(l_extendedprice as decimal(19,2)) as EXTDCOST
from {lineitem}""",
    "RM20101": """
select 'C' || lpad(cast(o_custkey as string), 8, '0') || ' ' as CUSTNMBR, 'AR' || lpad(cast(o_orderkey as string), 10, '0') as DOCNUMBR,
  case cast(o_orderkey % 10 as int) when 7 then 7 when 8 then 8 when 9 then 9 when 3 then 3 else 1 end as RMDTYPAL,
  cast(o_orderdate as date) as DOCDATE, case when o_orderkey % 97 = 0 then null else cast(o_orderdate as date) + 30 end as DUEDATE,
  cast(o_totalprice as decimal(19,4)) as ORTRXAMT,
  cast(case when o_orderkey % 23 = 0 or o_orderstatus = 'F' then 0 else o_totalprice end as decimal(19,4)) as CURTRXAM, 'VEF' as CURNCYID,
  case when o_orderkey % 8 = 0 then '' else '000' || cast(o_orderkey % 10 as string) end as SLPRSNID,
  case when o_orderkey % 9 = 0 then '' else cast(c_nationkey as string) end as SLSTERCD, 'NET30' as PYMTRMID, 1 as AGNGBUKT,
  case when o_orderkey % 41 = 0 then 1 else 0 end as VOIDSTTS
from {orders} join {customer} on o_custkey = c_custkey""",
}

SEQ_ROWS = 4  # record types per item (all stock, then three warehouses)

# Number and type of a line's sales document, in the form in which documents and
# lines are joined (staging and service trim the number).  Frames that are
# partitioned by them need no shuffle for that join, nor for anything per document.
_NUMBER = "trim(case when l_returnflag = 'R' then 'RTN' else 'INV' end || lpad(cast(l_orderkey as string), 10, '0'))"
_TYPE = "case when l_returnflag = 'R' then 4 else 3 end"

# Spark forms of blocks.  The quantities' cross join with a tiny helper table is
# ``explode(sequence(...))``, which generates the same rows per part without a
# nested-loop join; a salesperson's key has more digits than decimal(8,4) holds;
# documents and lines read frames that were joined with few shuffles (below).
SPARK_OVERRIDES = {
    "IV00102": SOURCE_SQL["IV00102"].replace(
        "from {part} cross join (select i as k from {seq}) ks",
        "from {part} lateral view explode(sequence(0, 3)) ks as k"),
    "RM00301": SOURCE_SQL["RM00301"].replace("decimal(8,4)", "decimal(23,4)"),
    "SOP30300": SOURCE_SQL["SOP30300"].replace(
        "from {lineitem} join {orders} on l_orderkey = o_orderkey join {part} on l_partkey = p_partkey", "from {lines}"),
    "SOP30200": SOURCE_SQL["SOP30200"].replace(
        "from {lineitem} group by 1, 2, 3) d\njoin {orders} on d.l_orderkey = o_orderkey join {customer} on o_custkey = c_custkey",
        f"from {{lineitem}} group by 1, 2, 3, {_NUMBER}) d\njoin {{ordered}} on trim(d.SOPNUMBE) = o_number and d.kind = o_type"
        " and d.l_orderkey >= o_orderkey and d.l_orderkey <= o_orderkey").replace(
        "min(l_suppkey) as SUPPKEY", f"min(l_suppkey) as SUPPKEY, {_TYPE} as kind"),
}

# Per-key sequence numbers of the blocks.  DuckDB runs the ``row_number()``
# text as written; Spark numbers the narrow line table first, and the block reads
# the number as a column: receipts with ``plans.ranking.bucketed_row_number`` (a
# part with a third of all receipts is cut at every value of the first order
# column), sales lines inside their document.
# (block, output column, value added to the row number, key exprs, order exprs)
SPARK_SEQUENCES = (
    ("SOP30300", "CMPNTSEQ", -1, ("l_orderkey", "l_returnflag = 'R'", "l_linenumber"),
     ("l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_shipdate")),
    ("IV10200", "RCTSEQNM", 0, ("l_partkey",),
     ("l_shipdate", "l_orderkey", "l_linenumber", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax")),
)


def by_document(lines: DataFrame) -> DataFrame:
    """Driver lines with an order, partitioned by sales document."""
    return lines.where(F.col("l_orderkey").isNotNull()).repartition(F.expr(_NUMBER), F.expr(_TYPE))


def _document_orders(orders: DataFrame) -> DataFrame:
    """Each order once for each type of document that it may have, with the document's number."""
    kinds = F.explode(F.array(*[F.struct(F.lit(prefix).alias("prefix"), F.lit(kind).alias("kind"))
                                for prefix, kind in (("INV", 3), ("RTN", 4))]))
    number = F.trim(F.concat("_k.prefix", F.lpad(F.col("o_orderkey").cast("string"), 10, "0")))
    return orders.select("*", kinds.alias("_k")).select(
        *orders.columns, number.alias("o_number"), F.col("_k.kind").alias("o_type"))


def _same_order() -> Column:
    """A line and its order are joined by document; the order's key, which the number may cut, is compared by
    bounds, so that the partitioning by document holds for the join."""
    return ((F.expr(_NUMBER) == F.col("o_number")) & (F.expr(_TYPE) == F.col("o_type"))
            & (F.col("l_orderkey") >= F.col("o_orderkey")) & (F.col("l_orderkey") <= F.col("o_orderkey")))


def _sales_lines(lineitem: DataFrame, orders: DataFrame, part: DataFrame, keys, order) -> DataFrame:
    """Numbered lines with their order and part: dealt by document for number and order, by part for the part,
    and by document again, as narrow driver columns."""
    numbered = clustered_row_number(by_document(lineitem), [F.expr(_NUMBER), F.expr(_TYPE)], [F.expr(k) for k in keys],
                                    list(order), "_seq")
    ordered = numbered.join(_document_orders(orders), _same_order())
    return by_document(ordered.join(part, F.col("l_partkey") == F.col("p_partkey")))


def _sequence_sql(text: str, column: str, adjust: int, keys) -> str:
    """The block with its ``row_number()`` expression replaced by the numbered lines' ``_seq``."""
    start = text.index(f"cast(row_number() over (partition by {', '.join(keys)}")
    end = text.index(f" as {column},", start)
    return f"{text[:start]}cast(_seq + ({adjust}) as int){text[end:]}"


# Order in which the blocks are emitted as CTEs for the DuckDB oracle.
SOURCE_ORDER = ("RM00303", "RM00301", "RM00201", "RM00101", "IV00101", "SOP30300", "SOP30200",
                "MC00100", "IV40700", "IV00102", "IV10200", "IV30300", "RM20101")


def duckdb_source_ctes() -> str:
    """The binding as DuckDB CTE text (``seq`` first, then every source)."""
    parts = [f"seq as (select i from range(0, {SEQ_ROWS}) t(i))"]
    names = {t: t for t in DRIVER_TABLES}
    names["seq"] = "seq"
    for src in SOURCE_ORDER:
        parts.append(f"{src} as ({SOURCE_SQL[src].format(**names).strip()})")
    return ",\n".join(parts)


class Sources:
    """Lazy ERP source frames over one directory of driver parquet tables."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self._frames: dict[str, DataFrame] = {}
        self._lock = threading.Lock()

    def driver(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def __getitem__(self, source: str) -> DataFrame:
        with self._lock:
            if source not in self._frames:
                text = SPARK_OVERRIDES.get(source, SOURCE_SQL[source])
                used = {t: self.driver(t) for t in DRIVER_TABLES if "{" + t + "}" in text}
                for name, column, adjust, keys, order in SPARK_SEQUENCES:
                    if name == source:
                        text = _sequence_sql(text, column, adjust, keys)
                        if source == "SOP30300":
                            used["lines"] = _sales_lines(self.driver("lineitem"), self.driver("orders"),
                                                         self.driver("part"), keys, order)
                        else:
                            used["lineitem"] = bucketed_row_number(used["lineitem"], [F.expr(k) for k in keys],
                                                                   list(order), "_seq")
                if source == "SOP30200":
                    orders = self.driver("orders").join(self.driver("customer"), F.col("o_custkey") == F.col("c_custkey"))
                    used |= {"lineitem": by_document(used["lineitem"]), "ordered": _document_orders(orders)}
                self._frames[source] = self.spark.sql(text, **used)
            return self._frames[source]


_CACHE: dict[tuple[str, str], Sources] = {}


def sources_for(spark: SparkSession, sf_dir: str) -> Sources:
    """One ``Sources`` per (application, directory); frames are lazy plans, not
    data.  Frames of an earlier application are dropped."""
    app = session_key(spark)
    key = (app, sf_dir.rstrip("/"))
    for old in [k for k in _CACHE if k[0] != app]:
        del _CACHE[old]
    if key not in _CACHE:
        _CACHE[key] = Sources(spark, sf_dir)
    return _CACHE[key]


class ExtractSources:
    """ERP source frames read from parquet extracts ``<dir>/<SOURCE>`` (the
    production layout: one folder per source table, written by the extract job
    or by ``materialize``), in the types of the registry."""

    def __init__(self, spark: SparkSession, extract_dir: str):
        self.spark = spark
        self.sf_dir = extract_dir.rstrip("/")

    def __getitem__(self, source: str) -> DataFrame:
        return typed(read_source(self.spark, source, f"{self.sf_dir}/{source}"), source).rows


def materialize(spark: SparkSession, sf_dir: str, extract_dir: str) -> ExtractSources:
    """Write every bound source table of ``sf_dir`` to ``extract_dir`` once."""
    src = Sources(spark, sf_dir)
    for name in SOURCE_ORDER:
        src[name].write.mode("overwrite").parquet(f"{extract_dir.rstrip('/')}/{name}")
    return ExtractSources(spark, extract_dir)


def use_extracts(spark: SparkSession, alias: str, extract_dir: str) -> None:
    """Make queries called with ``sf_dir=alias`` read the parquet extracts."""
    _CACHE[(session_key(spark), alias.rstrip("/"))] = ExtractSources(spark, extract_dir)
