"""Line dedup by site-relative frequency (operator 5).

Pages are grouped by host (here the source of a document); copies of one text
on a host are one page, so that a much-copied article does not turn into
boilerplate.  A line is boilerplate of its host if the share of the host's pages
that contain it is above ``ratio`` and at least ``min_pages`` pages do.  Such lines are dropped
from every page of that host; lines are compared without surrounding white space
and blank lines are always kept as they are.

A line travels as its 64-bit hash.  Lines are made distinct inside a page before
they are counted, and counts are combined on the map side.  The boilerplate of a
host is bounded: the pages of a line add up to at most the lines of all pages, so
a host has fewer than (lines per page) / ratio such lines.  They are gathered to
one short list per host, which joins the pages by host (sent to every task while
the lists hold at most ``BROADCAST_ROWS`` lines in all, which is counted), so a
page's text is not shuffled.

Defined results: a null text stays null and is no page; a null host is a host
of its own; repeated rows are one page but are each cleaned; tables may be empty;
other columns pass.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.stage import stage
from .common import BROADCAST_ROWS, shielded

RATIO = 0.01  # of the query; its oracle SQL holds the same values
MIN_PAGES = 5
_EDGE = " \t\n\x0b\x0c\r"


def line_hash(line: Column) -> Column:
    return F.xxhash64(F.trim(line, F.lit(_EDGE)))


def _has_text(line: Column) -> Column:
    return F.trim(line, F.lit(_EDGE)) != ""


def _host(col: Column) -> Column:
    """Null-safe equi-join key of a host."""
    return F.coalesce(F.concat(F.lit("h"), col), F.lit(""))


def repeated(docs: DataFrame, text_col: str = "text", host_col: str = "source", ratio: float = RATIO,
             min_pages: int = MIN_PAGES) -> DataFrame:
    """(__host, __line, pages, host_pages, dropped) of the lines on ``min_pages`` pages or more:
    those above the ratio are dropped, the others stay."""
    lines = F.filter(F.split(F.col(text_col), "\n"), _has_text)
    pages = (docs.where(F.col(text_col).isNotNull())
             .select(_host(F.col(host_col)).alias("__host"), F.md5(F.col(text_col).cast("binary")).alias("page"),
                     F.array_distinct(F.transform(lines, line_hash)).alias("lines"))
             .groupBy("__host", "page").agg(F.first("lines").alias("lines")))
    pages = stage(pages, "pages")  # line hashes only: read for the counts and for the totals
    counts = (pages.select("__host", F.explode("lines").alias("__line")).groupBy("__host", "__line")
              .agg(F.count(F.lit(1)).alias("pages")))
    totals = pages.groupBy("__host").agg(F.count(F.lit(1)).alias("host_pages"))
    return (counts.where(F.col("pages") >= min_pages).join(totals, "__host")
            .withColumn("dropped", F.col("pages") > ratio * F.col("host_pages")))


def boilerplate(docs: DataFrame, text_col: str = "text", host_col: str = "source", ratio: float = RATIO,
                min_pages: int = MIN_PAGES) -> DataFrame:
    """(__host, __line, pages, host_pages) of the lines above the ratio."""
    return repeated(docs, text_col, host_col, ratio, min_pages).where("dropped").drop("dropped")


def mark_lines(docs: DataFrame, text_col: str = "text", host_col: str = "source", ratio: float = RATIO,
               min_pages: int = MIN_PAGES) -> DataFrame:
    """``docs`` with ``__dropped``: the hashes of the host's boilerplate lines (empty, never null)."""
    found = stage(boilerplate(docs, text_col, host_col, ratio, min_pages).select("__host", "__line"), "boilerplate")
    lists = found.groupBy("__host").agg(F.collect_set("__line").alias("__dropped"))  # bounded per host, see above
    if found.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        lists = F.broadcast(lists)
    keyed = docs.select("*", _host(F.col(host_col)).alias("__host"))
    empty = F.array().cast("array<bigint>")
    return keyed.join(lists, "__host", "left").select(*[F.col(f"`{c}`") for c in docs.columns],
                                                      F.coalesce("__dropped", empty).alias("__dropped"))


def _is_dropped(line: Column) -> Column:
    return _has_text(line) & F.array_contains(F.col("__dropped"), line_hash(line))


def cleaned(text_col: str = "text") -> Column:
    """The text without its host's boilerplate lines."""
    kept = F.filter(F.split(F.col(text_col), "\n"), lambda x: ~_is_dropped(x))
    return F.when(F.size("__dropped") == 0, F.col(text_col)).otherwise(F.array_join(kept, "\n"))


@shielded
def drop_boilerplate(docs: DataFrame, text_col: str = "text", host_col: str = "source", length_col: str | None = None,
                     **options) -> DataFrame:
    """``docs`` with the boilerplate lines removed from the text; ``length_col``,
    if given, is set to the new length of changed texts."""
    marked = mark_lines(docs, text_col, host_col, **options)
    cols = []
    for c in docs.columns:
        if c == text_col:
            cols.append(cleaned(text_col).alias(c))
        elif c == length_col:
            changed = F.exists(F.split(F.col(text_col), "\n"), _is_dropped)
            cols.append(F.when(changed, F.length(cleaned(text_col)).cast(docs.schema[c].dataType))
                        .otherwise(F.col(f"`{c}`")).alias(c))
        else:
            cols.append(F.col(f"`{c}`"))
    return marked.select(*cols)


def line_report(docs: DataFrame) -> DataFrame:
    """doc_id, n_lines (with text), n_dropped, text_md5 of what stays: one row per document."""
    marked = mark_lines(docs.select("doc_id", "source", "text"))
    lines = F.filter(F.split(F.coalesce("text", F.lit("")), "\n"), _has_text)
    dropped = F.filter(lines, _is_dropped)
    return marked.select("doc_id", F.size(lines).cast("long").alias("n_lines"),
                         F.size(dropped).cast("long").alias("n_dropped"),
                         F.md5(cleaned("text").cast("binary")).alias("text_md5"))
