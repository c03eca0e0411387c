"""Benchmark decontamination (operator 4).

A set of normalised 13-word benchmark windows is sent to every task; each task
scans the word windows of its documents with a rolling hash, verifies every
hash hit word by word, and marks the words inside a verified window.  Documents
are never shuffled.

The benchmark side is a stated query set of checked size: it is cut into blocks
of about ``block_bytes`` of text by the hash of item and text (repeated rows count
once), and the documents are scanned once per block (one block for any usual
benchmark).  The hits of a block are written before the next one is read, so tasks
and driver hold the windows of one block at a time.  The spans of several
blocks are merged per document.

Defined results: null, empty or word-less text has no words and no hit; an item
without words matches nothing; repeated items and repeated rows are kept as
they are (an item id counts once per document; null item ids are ignored as
names but their windows still mark words); tables may be empty.  Extra columns
pass through whatever their names.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from ..plans.stage import discard, stage
from .common import alnum_words, shielded, with_arrow

WINDOW = 13
BLOCK_BYTES = 32 * 1024 * 1024
_MULT = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1

SPAN = StructType([StructField("start", LongType()), StructField("end", LongType())])


class WindowIndex:
    """Word numbers, and per window length the hashes and the item ids of each window."""

    def __init__(self, items, window: int):
        self.words: dict[bytes, int] = {}
        self.windows: dict[int, dict[tuple[int, ...], set]] = {}
        for item_id, text in items:
            ids = [self.words.setdefault(w, len(self.words)) for w in alnum_words(text)]
            length = min(window, len(ids))
            if not length:
                continue
            by = self.windows.setdefault(length, {})
            for i in range(len(ids) - length + 1):
                by.setdefault(tuple(ids[i:i + length]), set()).add(item_id)
        self.hashes = {n: np.unique(np.array([_tuple_hash(t) for t in by], dtype=np.uint64))
                       for n, by in self.windows.items()}


def _tuple_hash(ids) -> int:
    h = 0
    for x in ids:
        h = (h * _MULT + (x + 1) * (x + 7)) & _MASK
    return h


def scan_words(words: list[bytes], index: WindowIndex) -> tuple[list[tuple[int, int]], list[str]]:
    """Merged [start, end) word spans of verified windows, and the item ids found."""
    n = len(words)
    get = index.words.get
    ids = np.fromiter((get(w, -1) for w in words), dtype=np.int64, count=n)
    bad = np.concatenate(([0], np.cumsum(ids < 0)))
    value = ((ids + 1) * (ids + 7)).astype(np.uint64)
    mult = np.uint64(_MULT)
    spans: list[tuple[int, int]] = []
    found: set = set()
    for length, by in index.windows.items():
        if n < length:
            continue
        m = n - length + 1
        clear = np.flatnonzero(bad[length:] == bad[:m])  # windows made of benchmark words only
        if not len(clear):
            continue
        h = value[clear].copy()
        for j in range(1, length):
            h *= mult
            h += value[clear + j]
        known = index.hashes[length]
        at = np.minimum(np.searchsorted(known, h), len(known) - 1)
        for i in clear[known[at] == h].tolist():
            items = by.get(tuple(ids[i:i + length].tolist()))
            if items is not None:
                spans.append((i, i + length))
                found |= items
    merged: list[tuple[int, int]] = []
    for s, e in sorted(spans):
        if merged and s <= merged[-1][1]:
            merged[-1] = (merged[-1][0], max(e, merged[-1][1]))
        else:
            merged.append((s, e))
    return merged, sorted(str(x) for x in found if x is not None)


FOUND = [StructField("__n_words", LongType()), StructField("__spans", ArrayType(SPAN)),
         StructField("__items", ArrayType(StringType()))]


def find_hits(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id",
              item_text: str = "text", window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` with ``__n_words``, ``__spans`` (merged hit word spans) and ``__items``."""
    spark = docs.sparkSession
    bench = benchmark.select(F.col(item_col).alias("item"), F.coalesce(F.col(item_text), F.lit("")).alias("text"))
    bench = bench.distinct()
    size = bench.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    blocks = int(size // block_bytes) + 1
    out, before = docs, None
    for k in range(blocks):
        part = bench.where(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == k)
        # bounded by block_bytes of benchmark text, checked above
        shared = spark.sparkContext.broadcast([(r["item"], r["text"]) for r in part.collect()])
        fields = [StructField(f"{f.name}{k}", f.dataType) for f in FOUND]

        def make(shared=shared):
            index = WindowIndex(shared.value, window)

            def one(text):
                words = alnum_words(text)
                spans, items = scan_words(words, index) if words else ([], [])
                return len(words), [{"start": s, "end": e} for s, e in spans], items

            return one

        out = with_arrow(out, [text_col], make, fields)
        if k + 1 < blocks:  # this block's hits are written before the next block is read
            out = stage(out, "benchmark-block")
            shared.unpersist()
            if before is not None:
                discard(before)
            before = out
    base = [F.col(f"`{c}`") for c in docs.columns]
    if blocks == 1:
        return out.select(*base, *[F.col(f"{f.name}0").alias(f.name) for f in FOUND])
    spans = F.array_sort(F.flatten(F.array(*[F.col(f"__spans{k}") for k in range(blocks)])))
    # spans sorted by start: fold overlapping ones together
    last = F.element_at
    merged = F.aggregate(
        spans, F.array().cast(ArrayType(SPAN)),
        lambda acc, s: F.when((F.size(acc) > 0) & (s["start"] <= last(acc, -1)["end"]),
                              F.concat(F.slice(acc, 1, F.size(acc) - 1),
                                       F.array(F.struct(last(acc, -1)["start"].alias("start"),
                                                        F.greatest(last(acc, -1)["end"], s["end"]).alias("end")))))
        .otherwise(F.concat(acc, F.array(s))))
    items = F.array_sort(F.array_distinct(F.flatten(F.array(*[F.col(f"__items{k}") for k in range(blocks)]))))
    return out.select(*base, F.col("__n_words0").alias("__n_words"), merged.alias("__spans"), items.alias("__items"))


def n_hit():
    return F.aggregate("__spans", F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["start"])


def contaminated():
    """n_hit > 0 and at least a twentieth of the words are hit."""
    return (n_hit() > 0) & (20 * n_hit() >= F.col("__n_words"))


@shielded
def remove_contaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """``docs`` without its contaminated documents; all columns kept."""
    found = find_hits(docs, benchmark, **options)
    return found.where(~contaminated()).select(*[F.col(f"`{c}`") for c in docs.columns])


def contamination_report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The digest of the contract: one row per document."""
    found = find_hits(docs.select("doc_id", "text"), benchmark)
    return found.select(
        "doc_id", F.col("__n_words").alias("n_words"), n_hit().alias("n_hit"),
        F.size("__items").cast("long").alias("n_items"),
        F.sha2(F.array_join("__items", ",").cast("binary"), 256).alias("items_sha256"),
        contaminated().alias("contaminated"))


def brute_force(docs, items, window: int = WINDOW):
    """Plain reference used by the tests: [(doc_id, n_words, n_hit, n_items, sha, contaminated)]."""
    out = []
    for doc_id, text in docs:
        words = alnum_words(text)
        hit, names = set(), set()
        for item_id, item_text in items:
            item = alnum_words(item_text)
            length = min(window, len(item))
            for i in range(len(item) - length + 1) if length else ():
                for j in range(len(words) - length + 1):
                    if words[j:j + length] == item[i:i + length]:
                        hit.update(range(j, j + length))
                        names.add(item_id)
        ids = ",".join(sorted(str(x) for x in names if x is not None))
        out.append((doc_id, len(words), len(hit), len([x for x in names if x is not None]),
                    hashlib.sha256(ids.encode()).hexdigest(), len(hit) > 0 and 20 * len(hit) >= len(words)))
    return out
