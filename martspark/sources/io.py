"""Readers and writers.

* ``read_source``: one ERP table from parquet exports, or over JDBC with a
  partition column so the read is split across executors (its bounds are found
  from the data where none are given).  Credentials come
  only from environment variables (SURVEY D22).
* ``write_table``: materialise a layer as parquet (overwrite), optionally
  partitioned with dynamic partition overwrite (only touched partitions are
  replaced).
* ``write_csv``: export rows with a header, every field quoted and embedded
  quotes doubled (RFC 4180), one directory of part files per export.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

from .extracts import column_bounds


def read_source(spark: SparkSession, name: str, path: str | None = None, *, jdbc_table: str | None = None,
                partition_column: str | None = None, lower_bound: int | None = None,
                upper_bound: int | None = None, num_partitions: int | None = None) -> DataFrame:
    """Read ERP table ``name`` from ``path`` (parquet) or from JDBC.

    JDBC settings: ``MARTSPARK_JDBC_URL``, ``MARTSPARK_JDBC_USER``,
    ``MARTSPARK_JDBC_PASSWORD`` environment variables.
    """
    if path is not None:
        return spark.read.parquet(path)
    url = os.environ.get("MARTSPARK_JDBC_URL")
    if not url:
        raise ValueError(f"no path for source {name} and MARTSPARK_JDBC_URL is not set")
    reader = (spark.read.format("jdbc").option("url", url).option("dbtable", jdbc_table or name)
              .option("user", os.environ.get("MARTSPARK_JDBC_USER", ""))
              .option("password", os.environ.get("MARTSPARK_JDBC_PASSWORD", "")))
    if partition_column:
        if lower_bound is None or upper_bound is None:  # found from the data
            def run(query):
                return reader.option("dbtable", f"({query}) bounds").load()

            found = column_bounds(run, jdbc_table or name, partition_column) or (0, 0)
            lower_bound = found[0] if lower_bound is None else lower_bound
            upper_bound = found[1] if upper_bound is None else upper_bound
            reader = reader.option("dbtable", jdbc_table or name)
        reader = (reader.option("partitionColumn", partition_column).option("lowerBound", lower_bound)
                  .option("upperBound", upper_bound).option("numPartitions", num_partitions or 64))
    return reader.load()


def write_table(df: DataFrame, path: str, partition_by: list[str] | None = None, dynamic: bool = True) -> None:
    """Write a layer as parquet; with ``partition_by`` only touched partitions are replaced."""
    w = df.write.mode("overwrite")
    if partition_by:
        if dynamic:
            w = w.option("partitionOverwriteMode", "dynamic")
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    """CSV export with header, all fields quoted, quotes escaped by doubling."""
    (df.write.mode("overwrite").option("header", True).option("quoteAll", True)
     .option("quote", '"').option("escape", '"').option("encoding", "UTF-8").csv(path))


def write_bucketed(df: DataFrame, table: str, keys: list[str], buckets: int, sort: bool = True) -> None:
    """Save ``df`` as a catalog table bucketed (and sorted) by ``keys``.

    Sales headers and lines bucketed by the document key with the same bucket
    count join without a shuffle (storage-partitioned / bucketed join).
    """
    w = df.write.mode("overwrite").format("parquet").bucketBy(buckets, *keys)
    if sort:
        w = w.sortBy(*keys)
    w.saveAsTable(table)
