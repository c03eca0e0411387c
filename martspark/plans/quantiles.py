"""Exact order statistics by refinement, without sorting the rows.

A quantile cut is a row: the one at a given position in the order (value, key).
Each pass counts the staged rows between a few cuts (one hash aggregate) and
draws about ``CUTS`` rows of every interval that holds a wanted position, by a
hash of the key, as the cuts of the next pass.  An interval shrinks by a factor of about
``CUTS`` in each pass until it has at most ``LIMIT`` rows; those rows are
collected and the row is picked.  Several columns and positions share every
pass.  The driver sees some sampled rows and ``LIMIT`` rows for each position,
whatever the table holds.

Scores (``ntiles``) then compare every row with the cuts: no join, no shuffle.
Ties are broken by the key, which must be unique and not null; null values come
first in ascending and last in descending order, as in SQL windows of Spark.
"""

from __future__ import annotations

import json
from collections import defaultdict
from collections.abc import Callable, Sequence
from decimal import Decimal
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LIMIT = 8192
CUTS = 64
_STEP = 1 << 10


class Spec(NamedTuple):
    """Order of the rows by a value column, the key as tie-break."""
    value: str
    descending: bool = False


def _up_to(key: str, spec: Spec, cut: tuple) -> Column:
    """Whether a row is not behind the cut (value, key)."""
    value, name = cut
    v = F.col(spec.value)
    tie = F.col(key) <= F.lit(name)
    if value is None:
        same = v.isNull() & tie
        return (v.isNotNull() | same) if spec.descending else same
    before = (v > F.lit(value)) if spec.descending else (v < F.lit(value))
    here = before | ((v == F.lit(value)) & tie)
    return F.coalesce(here, F.lit(not spec.descending))


def _sorted(rows: list[tuple], spec: Spec) -> list[tuple]:
    rows = sorted(rows, key=lambda r: r[1])
    some = sorted((r for r in rows if r[0] is not None), key=lambda r: r[0], reverse=spec.descending)
    none = [r for r in rows if r[0] is None]
    return some + none if spec.descending else none + some


def _json(value) -> str:
    return str(value) if isinstance(value, Decimal) else json.dumps(value, default=str)


def _interval_no(df: DataFrame, key: str, spec: Spec, cuts: Sequence[tuple]) -> Column:
    """Number of the sorted cuts that a row is behind.  The cuts are one literal, not an expression for each."""
    if not cuts:
        return F.lit(0)
    text = ",".join(f'{{"v":{_json(v)},"k":{_json(k)}}}' for v, k in cuts)
    kind = f"array<struct<v:{df.schema[spec.value].dataType.simpleString()},k:{df.schema[key].dataType.simpleString()}>>"
    v, name = F.col(spec.value), F.col(key)

    def behind(c):
        further = (v < c["v"]) if spec.descending else (v > c["v"])
        nulls = (v.isNull() & c["v"].isNotNull()) if spec.descending else (v.isNotNull() & c["v"].isNull())
        return F.coalesce(further, F.lit(False)) | nulls | (v.eqNullSafe(c["v"]) & (name > c["k"]))

    return F.size(F.filter(F.from_json(F.lit(f"[{text}]"), kind), behind))


class _Interval(NamedTuple):
    """Rows behind ``lo`` and up to ``hi`` (None: open), with ``before`` rows up to ``lo`` and ``rows`` in it."""
    lo: tuple | None
    hi: tuple | None
    before: int
    rows: int
    cuts: tuple


def _marked(df: DataFrame, key: str, specs: Sequence[Spec], open_: Sequence[Sequence[_Interval]]) -> DataFrame:
    """Rows of the intervals, once for each spec: spec number and interval x _STEP + number between its cuts."""
    entries = []
    for i, (spec, intervals) in enumerate(zip(specs, open_, strict=True)):
        code = F.lit(None).cast("int")
        for j, x in enumerate(intervals):
            inside = F.lit(True)
            if x.lo is not None:
                inside = inside & ~_up_to(key, spec, x.lo)
            if x.hi is not None:
                inside = inside & _up_to(key, spec, x.hi)
            code = F.when(inside, F.lit(j * _STEP) + _interval_no(df, key, spec, x.cuts)).otherwise(code)
        entries.append(F.struct(F.lit(i).alias("spec"), code.alias("code")))
    values = sorted({s.value for s in specs})
    return (df.select(F.col(key).alias("_key"), *values, F.explode(F.array(*entries)).alias("e"))
            .select("_key", *values, "e.spec", "e.code").where(F.col("code").isNotNull()))


def _drawn(df: DataFrame, key: str, specs: Sequence[Spec], large: Sequence[Sequence[_Interval]], number: int) -> dict:
    """Some rows (value, key) of every interval, about ``CUTS`` of each."""
    rates = F.lit(1)
    for i, intervals in enumerate(large):
        for j, x in enumerate(intervals):
            here = (F.col("spec") == i) & (F.col("code") == j * _STEP)
            rates = F.when(here, F.lit(max(1, x.rows // CUTS))).otherwise(rates)
    uncut = [[x._replace(cuts=()) for x in xs] for xs in large]
    rows = _marked(df, key, specs, uncut).where(F.pmod(F.xxhash64("_key", F.lit(number)), rates) == 0)
    out: dict = defaultdict(list)
    for r in rows.collect():
        out[r.spec, r.code // _STEP].append((r[specs[r.spec].value], r["_key"]))
    return out


def _parts(x: _Interval, counts: Sequence[int]) -> list[_Interval]:
    """The intervals between the cuts of ``x``."""
    out, lo, before = [], x.lo, x.before
    for n, hi in zip(counts, (*x.cuts, x.hi), strict=True):
        out.append(_Interval(lo, hi, before, n, ()))
        lo, before = hi, before + n
    return out


def order_statistics(df: DataFrame, key: str, specs: Sequence[Spec],
                     positions: Callable[[int], Sequence[int]], limit: int = LIMIT) -> tuple[int, list[list[tuple]]]:
    """Number of rows, and for each spec the (value, key) at each 1-based position of ``positions(rows)``.
    ``df`` should be staged: it is read once for each pass."""
    total = df.count()
    wanted = sorted({p for p in positions(total) if 1 <= p <= total})
    small: list[dict[int, _Interval]] = [{} for _ in specs]
    open_ = [[_Interval(None, None, 0, total, ())] if wanted else [] for _ in specs]
    number = 0
    while any(open_):
        large = []
        for found, intervals in zip(small, open_, strict=True):
            found.update({p: x for x in intervals if x.rows <= limit for p in wanted if x.before < p <= x.before + x.rows})
            large.append([x for x in intervals if x.rows > limit])
        if not any(large):
            break
        number += 1
        drawn = _drawn(df, key, specs, large, number)
        open_ = [[x._replace(cuts=tuple(_sorted(drawn[i, j], spec))) for j, x in enumerate(xs)]
                 for i, (spec, xs) in enumerate(zip(specs, large, strict=True))]
        counts = {(r.spec, r.code): r["count"] for r in _marked(df, key, specs, open_).groupBy("spec", "code").count().collect()}
        open_ = [[part for j, x in enumerate(xs) for part in _parts(x, [counts.get((i, j * _STEP + b), 0)
                                                                       for b in range(len(x.cuts) + 1)])
                  if any(part.before < p <= part.before + part.rows for p in wanted)] for i, xs in enumerate(open_)]
    last = [sorted(set(m.values()), key=lambda x: x.before) for m in small]
    held: dict = defaultdict(list)
    for r in _marked(df, key, specs, last).collect():
        held[r.spec, r.code // _STEP].append((r[specs[r.spec].value], r["_key"]))
    out = []
    for i, spec in enumerate(specs):
        rows = {x: _sorted(held[i, j], spec) for j, x in enumerate(last[i])}
        out.append([rows[small[i][p]][p - small[i][p].before - 1] for p in wanted])
    return total, out


def tile_ends(n: int, buckets: int) -> list[int]:
    """Last position of every tile but the last of SQL ``ntile(buckets)`` over ``n`` rows."""
    q, rem = divmod(n, buckets)
    return [t * q + min(t, rem) for t in range(1, buckets)]


def ntiles(df: DataFrame, key: str, specs: dict[str, Spec], buckets: int, limit: int = LIMIT) -> DataFrame:
    """``df`` (staged) with SQL ``ntile(buckets)`` over every spec, under the spec's name."""
    n, cuts = order_statistics(df, key, list(specs.values()), lambda n: tile_ends(n, buckets), limit)
    at = [e for e in tile_ends(n, buckets) if e >= 1]
    out = {}
    for (name, spec), found in zip(specs.items(), cuts, strict=True):
        cut_at = dict(zip(sorted(set(at)), found, strict=True))
        behind = [F.when(_up_to(key, spec, cut_at[e]), 0).otherwise(1) for e in at]
        out[name] = sum(behind, F.lit(1)).cast("int")
    return df.withColumns(out)


def medians(df: DataFrame, key: str, values: Sequence[str], limit: int = LIMIT) -> list[float | None]:
    """Exact interpolated median of every value column (no null values) of ``df`` (staged)."""
    n, found = order_statistics(df, key, [Spec(v) for v in values], lambda n: ((n + 1) // 2, n // 2 + 1), limit)
    return [sum(float(v) for v, _ in rows) / len(rows) if n else None for rows in found]
