"""Helpers shared by the training-data operators.

``with_arrow`` runs a Python function over Arrow batches and appends its result
columns to the rows, without a shuffle: memory is bounded by one batch.
``broadcastable`` decides from a counted size, never from a guess.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import wraps
from inspect import signature

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructField, StructType

# Rows that a Python worker holds as objects at a time: Spark's batches have 10,000, tens of MB of texts beside their
# Arrow form and the results.
SLICE_ROWS = 1_000

# Ceiling for anything sent whole to every task, in rows of a few machine words.
BROADCAST_ROWS = 2_000_000

# Byte classes of the two word definitions used by the contracts.
# "ASCII word": digits, letters and every byte of a non-ASCII code point.
_WORD_BYTES = bytes(b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def lowered(text: str | None) -> bytes:
    """UTF-8 bytes with A-Z (only) lower-cased; null is empty."""
    return (text or "").encode("utf-8", "surrogatepass").lower()


def alnum_words(text: str | None) -> list[bytes]:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the text with A-Z lower-cased."""
    return lowered(text).translate(_WORD_BYTES).split()


def space_words(text: str | None) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of the text with A-Z lower-cased
    (``bytes.split`` cuts at exactly those six bytes)."""
    return lowered(text).split()


def _slices(batches):
    for b in batches:
        for start in range(0, b.num_rows, SLICE_ROWS):
            yield b.slice(start, SLICE_ROWS)


def with_arrow_batches(df: DataFrame, inputs: Sequence[str], make: Callable[[], Callable],
                       fields: Sequence[StructField]) -> DataFrame:
    """Append ``fields`` computed batch by batch: ``make()`` is called once per
    task and returns ``fn(*lists) -> list of result lists``."""
    out = StructType(list(df.schema.fields) + list(fields))
    index = [df.columns.index(c) for c in inputs]
    new_types = [f.type for f in to_arrow_schema(StructType(list(fields)))]
    names = [f.name for f in out.fields]

    def run(batches):
        fn = make()
        for b in _slices(batches):
            res = fn(*[b.column(i).to_pylist() for i in index])
            new = [pa.array(v, type=t) for v, t in zip(res, new_types, strict=True)]
            yield pa.RecordBatch.from_arrays([*b.columns, *new], names=names)

    return df.mapInArrow(run, out)


def with_arrow(df: DataFrame, inputs: Sequence[str], make: Callable[[], Callable],
               fields: Sequence[StructField]) -> DataFrame:
    """``with_arrow_batches`` for a function of one row that returns a tuple."""
    n = len(fields)

    def make_batch():
        fn = make()

        def each(*cols):
            rows = [fn(*r) for r in zip(*cols, strict=True)]
            return [[r[k] for r in rows] for k in range(n)]

        return each

    return with_arrow_batches(df, inputs, make_batch, fields)


def flat_arrow(df: DataFrame, make: Callable[[], tuple[Callable, Callable]], schema: StructType) -> DataFrame:
    """``make()`` returns (per_batch, at_end): both give lists of result rows."""
    target = to_arrow_schema(schema)

    def rows(found):
        cols = list(zip(*found, strict=True)) if found else [[] for _ in target]
        return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(cols, target, strict=True)],
                                          schema=target)

    def run(batches):
        per_batch, at_end = make()
        for b in _slices(batches):
            if (found := per_batch(*[c.to_pylist() for c in b.columns])):
                yield rows(found)
        if found := at_end():
            yield rows(found)

    return df.mapInArrow(run, schema)


def shielded(fn):
    """For a function from rows to the same rows (or some of them): input columns that begin with ``__`` bear
    other names inside, so that they cannot clash with the working columns of the operator."""
    kind = signature(fn)

    @wraps(fn)
    def run(docs: DataFrame, *args, **kwargs) -> DataFrame:
        inner = {c: f"input {i} {c[2:]}" for i, c in enumerate(docs.columns) if c.startswith("__")}
        if not inner:
            return fn(docs, *args, **kwargs)
        bound = kind.bind(docs.withColumnsRenamed(inner), *args, **kwargs)
        for name, value in bound.arguments.items():
            if name.endswith("_col") and value in inner:
                bound.arguments[name] = inner[value]
        return fn(*bound.args, **bound.kwargs).withColumnsRenamed({v: k for k, v in inner.items()})

    return run


def broadcastable(df: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """Broadcast hint on a narrow, already staged frame of at most ``limit``
    rows (counted); beyond it the join is left to the planner."""
    return F.broadcast(df) if df.limit(limit + 1).count() <= limit else df
