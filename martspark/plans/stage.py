"""Materialise an intermediate result once when several branches of one plan
read it.

Catalyst re-derives a DataFrame in every branch that uses it, and prunes each
branch differently, so shuffles are not always reused.  ``stage`` writes the
frame as a parquet table in the shared folder named by ``spark.checkpoint.dir``
(never a machine-local cache) and returns a frame reading it: one job computes
it, lineage is cut, every branch reads the same columnar files (with column
pruning and filter pushdown), and a lost executor only costs re-reading them.
Use it for compact, reused intermediates (customer activity, document totals,
per-customer metrics), not for raw facts.
"""

from __future__ import annotations

import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from ..session import checkpoint_dir, session_key


_STAGED: dict[str, list[str]] = {}

# Spark's own clean-up of an execution's shuffle files at its end.  A frame that is written is planned for the write
# alone, so nothing reads its shuffles afterwards; else they stay until the driver happens to collect its garbage.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_dropped(spark: SparkSession):
    """Writes inside the block delete their shuffle files as soon as they end."""
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(_CLEANUP) if before is None else spark.conf.set(_CLEANUP, before)


def stage(df: DataFrame, name: str = "stage") -> DataFrame:
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    with shuffles_dropped(spark):
        df.write.mode("overwrite").parquet(path)
    _STAGED.setdefault(session_key(spark), []).append(path)
    out = spark.read.parquet(path)
    out._staged_path = path
    return out


def _delete(spark: SparkSession, path: str) -> None:
    jvm = getattr(spark, "_jvm", None)
    if jvm is None:  # Spark Connect: the folder's owner cleans up
        return
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(target, True)


def discard(df: DataFrame) -> None:
    """Delete the folder of a staged frame that no other plan reads any more."""
    path = getattr(df, "_staged_path", None)
    if path:
        _delete(df.sparkSession, path)
        _STAGED.get(session_key(df.sparkSession), [path]).remove(path)


@contextmanager
def staging(spark: SparkSession):
    """Everything staged inside the block is deleted at its end, once the
    results that read it have been written; staged frames put into the list
    that the block gets stay."""
    known = _STAGED.setdefault(session_key(spark), [])
    start = len(known)
    keep: list[DataFrame] = []
    try:
        yield keep
    finally:
        kept = [df._staged_path for df in keep]
        for path in known[start:]:
            if path not in kept:
                _delete(spark, path)
        known[start:] = [path for path in known[start:] if path in kept]
