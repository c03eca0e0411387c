"""Registry of named queries: Spark builder + DuckDB oracle text.

A query is a function ``(spark, sf_dir) -> DataFrame`` that reads the driver
tables in ``sf_dir`` through the source binding and runs one operator (or one
operator chain) of the library over the whole tables.  ``presentable`` is the
last projection: decimals become doubles so that both engines report money in
the same type.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def presentable(df: DataFrame) -> DataFrame:
    """Cast decimal columns to double (one output convention for all queries)."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, DecimalType):
            cols.append(F.col(f"`{f.name}`").cast("double").alias(f.name))
        else:
            cols.append(F.col(f"`{f.name}`"))
    return df.select(*cols)


def register(name: str, oracle: str | None = None):
    """Decorator: register ``fn`` under ``name`` with an optional oracle."""

    def deco(fn: QueryFn) -> QueryFn:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return presentable(fn(spark, sf_dir))

        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if oracle is not None:
            ORACLES[name] = oracle
        return run

    return deco
