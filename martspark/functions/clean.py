"""Column helpers shared by the staging layer (all JVM-side expressions)."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def txt(c: str | Column) -> Column:
    """Mandatory text: padded char → trimmed string."""
    return F.trim(col(c))


def opt_txt(c: str | Column) -> Column:
    """Optional text: trimmed, blank → NULL."""
    return F.nullif(F.trim(col(c)), F.lit(""))


def opt_txt_or(c: str | Column, default: str) -> Column:
    """Optional text with a default for NULL/blank."""
    return F.coalesce(opt_txt(c), F.lit(default))


def dec(c: str | Column, precision: int, scale: int) -> Column:
    """Tolerant decimal cast at the source boundary (ANSI mode would raise)."""
    return col(c).try_cast(f"decimal({precision},{scale})")


def integer(c: str | Column) -> Column:
    return col(c).try_cast("int")


def not_blank(c: str | Column) -> Column:
    """Key filter: not NULL and not only blanks."""
    return col(c).isNotNull() & (F.trim(col(c)) != F.lit(""))


def code_label(c: str | Column, labels: Mapping[int, str], default: str) -> Column:
    """Decode an integer code with a fixed label table (ordered ``when`` chain)."""
    expr = None
    for code, label in labels.items():
        cond = col(c) == F.lit(code)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit(default))


def concat_skip_nulls(*parts: Column) -> Column:
    """SQL ``concat(...)`` of the reference dialects: NULL arguments are skipped."""
    return F.concat_ws("", *parts)
