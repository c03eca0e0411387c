"""Typed extracts (S01, S02): reads enforce the registry's schema, bad rows are
kept with a reason, loads go on from a high-water mark.

``typed`` brings an extract of any column types (text exports included) to the
types of the source registry.  A value that its type cannot hold exactly (no
number, no date, lost decimals, lost time of day) rejects its row, never turns into
NULL; a registry column that the extract does not have is an error of the whole
extract; further columns are dropped.  Columns that already have their type cost
nothing.

``ExtractLoader`` keeps the tables in month parts (``sources.parts``).  A load reads
the rows from the month of the table's high-water mark on (a pushed-down filter),
replaces those months, moves the mark, and publishes rows, rejects and mark
together, so a load that is repeated changes nothing.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DateType, NumericType, StringType, TimestampType

from .parts import PartStore
from .schemas import SOURCES

REJECTS = "table_name string, reason string, row_json string"


class Typed(NamedTuple):
    rows: DataFrame
    rejects: DataFrame


def _converted(name: str, have: DataType, want: DataType) -> tuple[Column, Column | None]:
    """The column in the wanted type, and whether its value does not fit (None: it always does)."""
    c = F.col(f"`{name}`")
    if have == want:
        return c, None
    new = c.try_cast(want)
    if isinstance(want, StringType):
        return new, None
    bad = new.isNull()
    if isinstance(want, NumericType):
        exact = c.try_cast("decimal(38,10)")
        bad = bad | exact.isNull() | (exact != new.cast("decimal(38,10)"))
    elif isinstance(want, DateType) and isinstance(have, TimestampType):
        bad = bad | (new.cast("timestamp") != c)
    return new, c.isNotNull() & F.coalesce(bad, F.lit(True))


def typed(df: DataFrame, name: str) -> Typed:
    """The rows of source ``name`` in the registry's types, and the rejected ones (table_name, reason, row_json)."""
    schema = SOURCES[name][2]
    have = {f.name: f.dataType for f in df.schema}
    missing = [f.name for f in schema if f.name not in have]
    if missing:
        raise ValueError(f"extract of {name} lacks {', '.join(missing)}")
    new = {f.name: _converted(f.name, have[f.name], f.dataType) for f in schema}
    reasons = [F.when(bad, F.lit(f"{c}: not {schema[c].dataType.simpleString()}")) for c, (_, bad) in new.items()
               if bad is not None]
    columns = [c.alias(n) for n, (c, _) in new.items()]
    if not reasons:
        return Typed(df.select(*columns), df.sparkSession.createDataFrame([], REJECTS))
    reason = F.concat_ws("; ", *reasons)
    rejects = df.where(reason != "").select(F.lit(name).alias("table_name"), reason.alias("reason"),
                                            F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns])).alias("row_json"))
    return Typed(df.where(reason == "").select(*columns), rejects)


def column_bounds(read, table: str, column: str) -> tuple[int, int] | None:
    """Smallest and largest value of a partition column, found from the data: ``read`` runs a
    query against the source.  None without any value."""
    r = read(f"select min({column}) as lo, max({column}) as hi from {table}").first()
    return None if r["lo"] is None else (int(r["lo"]), int(r["hi"]))


class ExtractLoader:
    """Loads extracts of the registry's tables into ``base_dir``, from their high-water mark on."""

    def __init__(self, spark: SparkSession, base_dir: str):
        self.spark, self.store = spark, PartStore(spark, base_dir)

    def mark(self, name: str):
        """Start of the latest month loaded (None before the first load)."""
        marks = self.store.read("marks", [name])
        row = marks.first() if marks is not None else None
        return row["mark"] if row else None

    def load(self, name: str, extract: DataFrame, mark_column: str) -> list[str]:
        """Load the rows of an extract that are not older than the mark's month; returns the replaced months."""
        since = self.mark(name)
        day = F.col(mark_column).try_cast("date")
        if since is not None:  # rows without a date cannot be placed and are read every time
            extract = extract.where((day >= F.lit(since)) | day.isNull())
        rows, rejects = typed(extract, name)
        month = F.coalesce(F.date_format(F.col(mark_column).cast("date"), "yyyyMM"), F.lit("undated"))
        rows = rows.withColumn("part", month)
        parts = {r.part for r in rows.select("part").distinct().collect()}  # months
        entry = self.store.state()["tables"].get(name, {"parts": {}})["parts"]
        first = f"{since:%Y%m}" if since is not None else ""
        parts |= {p for p in entry if p >= first}  # rows that are gone from the read months go here too
        change = self.store.change()
        change.replace(name, rows, parts)
        placed = F.coalesce(F.date_format(F.get_json_object("row_json", f"$.{mark_column}").try_cast("date"), "yyyyMM"),
                            F.lit("undated"))
        rejects = rejects.withColumn("part", F.concat_ws("_", "table_name", placed))
        known = self.store.state()["tables"].get("rejects", {"parts": {}})["parts"]
        stale = {p for p in known if p.startswith(f"{name}_") and p.split("_", 1)[1] >= first}
        found = {r.part for r in rejects.select("part").distinct().collect()}
        change.replace("rejects", rejects, stale | found)
        dated = sorted(p for p in parts if p != "undated")
        if dated:
            latest = self.spark.range(1).select(F.to_date(F.lit(dated[-1]), "yyyyMM").alias("mark"), F.lit(name).alias("part"))
            change.replace("marks", latest, [name])
        change.publish()
        return sorted(parts)

    def table(self, name: str) -> DataFrame:
        return self.store.read(name)

    def rejects(self) -> DataFrame:
        return self.store.read("rejects")
