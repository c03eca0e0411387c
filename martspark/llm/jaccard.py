"""Exact n-gram Jaccard self-join by rare-first prefix filtering (operator 6).

Sets are the distinct shingles of a text; two texts link when
den * |intersection| >= num * |union|.  A ``Rule`` (words of a shingle, num, den)
says which: ``OP6`` (4 words, 85/100) is the query's, callers may pass another.

1. Shingles get one global order, rarest first.  Their frequencies are counted
   over all documents in 2^18 hash buckets (an order by any common key is
   correct, the counts only make it selective), so the table has a fixed size.
2. Texts with the same set are one class; its smallest id stands for it.
3. Each representative emits its prefix: the first
   n - ceil(n num / den) + 1 shingles.  Two sets that link share a prefix shingle.  Shingles with a single
   holder leave here.
4. A shared prefix shingle with two holders gives their pair.  On the others, a
   star round pairs all holders with a few leaders, not with each other.  Pairs
   pass the length, positional and suffix filters, are verified once on their
   full sets, and the found links are contracted to components.  The round only
   saves work.
5. The last pass is exact.  On each prefix shingle whose holders are still in
   different components, all remaining cross-component pairs go through the
   filters; what passes joins its documents to candidate clusters (a spanning
   set of pairs is enough for that).  Inside a cluster all cross-component pairs
   are verified, block against block, with one matrix product of the blocks'
   shingle incidence.  Holders and clusters are cut into cells of about 256
   documents; cells of one component are not compared with each other, so a
   large group of near copies costs nothing once the round has merged it.

The suffix filter compares histograms of the sets over hash ranges, about one
range for eight shingles: the sum of differences is a lower bound of the
symmetric difference.  Shingles travel as 64-bit hashes.

Defined results: null and word-less texts have the empty set and link with
nothing; fewer words than a shingle has are one shingle; a null id links with nothing and
has a null component; repeated rows belong to the same class; an id that occurs
with several texts is judged row by row; tables may be empty.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, BooleanType, IntegerType, LongType, StructField, StructType

from ..plans.stage import discard, stage, staging
from .common import broadcastable, flat_arrow, shielded, space_words, with_arrow, with_arrow_batches
from .components import connected_components

SKETCH_BITS = 18
RANGES = 64          # for a set of up to 512 shingles; doubled with the size
CELL = 256
STAR_ROUNDS = 1
LEADERS = 3
# Shingles of three or more holders sent whole to every task, at most; their number grows with the corpus, so the
# join is shuffled beyond it.  A hash table of these takes a few times 8 bytes a row, also in the driver that builds it.
TOKENS = 250_000

_K = np.uint64(0x9E3779B97F4A7C15)
_S = np.uint64(29)


class Rule(NamedTuple):
    """Words of a shingle and the least similarity num / den, in integers."""
    words: int
    num: int
    den: int


OP6 = Rule(4, 85, 100)


def shingles(text: str | None, rule: Rule = OP6) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's shingles."""
    words = space_words(text)
    if not words:
        return np.zeros(0, dtype=np.uint64)
    h = pd.util.hash_array(np.array(words, dtype=object), categorize=False)
    size = min(rule.words, len(h))
    m = len(h) - size + 1
    s = (h[:m] + np.uint64(size)) * _K
    for i in range(1, size):
        s = ((s ^ (s >> _S)) + h[i:i + m]) * _K
    return np.unique(s ^ (s >> _S))


def smallest_overlap(a, b, rule: Rule = OP6):
    """Least |intersection| with den * i >= num * (a + b - i)."""
    return -((-rule.num * (a + b)) // (rule.num + rule.den))


def prefix_length(n: int, rule: Rule = OP6) -> int:
    return n - (-((-rule.num * n) // rule.den)) + 1


def sketch(docs: DataFrame, text_col: str = "text", bits: int = SKETCH_BITS, rule: Rule = OP6) -> np.ndarray:
    """Shingle occurrences (per document) of every hash bucket."""

    def make():
        total = np.zeros(1 << bits, dtype=np.int64)

        def per_batch(texts):
            nonlocal total
            for i in range(0, len(texts), 512):
                found = [shingles(t, rule) for t in texts[i:i + 512]]
                total += np.bincount((np.concatenate(found) >> np.uint64(64 - bits)).astype(np.int64),
                                     minlength=1 << bits)
            return []

        def at_end():
            at = np.flatnonzero(total)
            return list(zip(at.tolist(), total[at].tolist(), strict=True))

        return per_batch, at_end

    schema = StructType([StructField("bucket", IntegerType()), StructField("n", LongType())])
    found = flat_arrow(docs.select(text_col), make, schema).groupBy("bucket").agg(F.sum("n").alias("n"))
    table = found.toArrow()  # at most 2^bits rows
    out = np.zeros(1 << bits, dtype=np.int64)
    out[table.column("bucket").to_numpy()] = table.column("n").to_numpy()
    return out


def describe(docs: DataFrame, counts: np.ndarray, text_col: str = "text", rule: Rule = OP6) -> DataFrame:
    """``docs`` without text, with n, f1, f2 (fingerprint of the set), prefix (rare first) and ranges."""
    bits = len(counts).bit_length() - 1
    # rank of a bucket: equal counts keep one order
    shared = docs.sparkSession.sparkContext.broadcast(counts)

    def make():
        counts = shared.value

        def one(text):
            s = shingles(text, rule)
            n = len(s)
            if not n:
                return 0, 0, 0, [], b""
            mixed = (s ^ (s >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
            f1 = int(mixed.sum(dtype=np.uint64).view(np.int64))
            f2 = int(np.bitwise_xor.reduce(mixed * _K ^ s).view(np.int64))
            order = np.lexsort((s, counts[(s >> np.uint64(64 - bits)).astype(np.int64)]))[:prefix_length(n, rule)]
            return n, f1, f2, s[order].view(np.int64), range_counts(s).tobytes()

        return one

    out = with_arrow(docs, [text_col], make, [
        StructField("n", LongType()), StructField("f1", LongType()), StructField("f2", LongType()),
        StructField("prefix", ArrayType(LongType())), StructField("ranges", BinaryType())])
    return out.drop(text_col)


def range_counts(s: np.ndarray) -> np.ndarray:
    """Shingles in each hash range (by low bits: the buckets of the order use the high ones), at most 255."""
    size = RANGES
    while size * 8 < len(s):
        size *= 2
    return np.minimum(np.bincount((s & np.uint64(size - 1)).astype(np.int64), minlength=size), 255).astype(np.uint8)


def folded(ranges: np.ndarray, size: int) -> np.ndarray:
    """Counts (last axis) over ``size`` ranges; capped counts stay at the cap."""
    while ranges.shape[-1] > size:
        half = ranges.shape[-1] // 2
        ranges = np.minimum(ranges[..., :half].astype(np.int16) + ranges[..., half:], 255).astype(np.uint8)
    return ranges


def may_link(na, nb, ranges_a: np.ndarray, ranges_b: np.ndarray, rule: Rule = OP6):
    """Suffix filter: range differences within the symmetric difference that a link allows.
    Counts capped at 255 differ by no more than the true ones, so the bound holds."""
    size = min(ranges_a.shape[-1], ranges_b.shape[-1])
    a, b = folded(ranges_a, size), folded(ranges_b, size)
    gap = np.abs(a.astype(np.int16) - b.astype(np.int16)).sum(axis=-1, dtype=np.int64)
    return gap <= na + nb - 2 * smallest_overlap(na, nb, rule)


def _length_ok(na, nb, rule: Rule):
    return (F.least(na, nb) * rule.den) >= (F.greatest(na, nb) * rule.num)


def _position_ok(na, pa, nb, pb, rule: Rule):
    most = F.least(pa, pb) + 1 + F.least(na - pa - 1, nb - pb - 1)
    return most * (rule.num + rule.den) >= (na + nb) * rule.num


class Join:
    """The steps of one run; ``texts`` has (doc, text_hash, text), ``reps`` a class in each row
    (id, doc, text_hash, n, f1, ranges), ``holders`` (token, id, n, pos) of the shingles with three
    or more holders.  Classes have numbers of their own, so an id may stand for several of them."""

    def __init__(self, texts: DataFrame, reps: DataFrame, holders: DataFrame, rule: Rule = OP6):
        self.texts, self.reps, self.holders, self.rule = texts, reps, holders, rule
        self.spark = texts.sparkSession
        self.comp = self.spark.createDataFrame([], "id long, comp long")

    def labelled(self) -> DataFrame:
        """Prefix shingle holders with their present component."""
        return (self.holders.join(self.comp, "id", "left")
                .select("token", "id", "n", "pos", F.coalesce("comp", "id").alias("comp")))

    def with_ranges(self, pairs: DataFrame) -> DataFrame:
        for side in ("a", "b"):
            r = self.reps.select(F.col("id").alias(side), F.col("n").alias(f"n{side}"), F.col("f1").alias(f"f{side}"),
                                 F.col("ranges").alias(f"r{side}"))
            pairs = pairs.join(r, side)
        return pairs

    def suffix_filtered(self, pairs: DataFrame) -> DataFrame:
        """Pairs (a, b) that pass the suffix filter, with the fingerprints fa, fb."""
        rule = self.rule

        def make():
            def each(na, nb, ra, rb):
                return [[bool(may_link(x, y, np.frombuffer(a, dtype=np.uint8), np.frombuffer(b, dtype=np.uint8), rule))
                         for x, y, a, b in zip(na, nb, ra, rb, strict=True)]]

            return each

        d = with_arrow_batches(self.with_ranges(pairs), ["na", "nb", "ra", "rb"], make, [StructField("ok", BooleanType())])
        return d.where("ok").select("a", "b", "fa", "fb")

    def verified(self, pairs: DataFrame) -> DataFrame:
        """Links (u, v) among the staged pairs (a, b, fa, fb), each pair once on full sets."""
        rule = self.rule
        ids = pairs.select(F.explode(F.array(F.struct(F.col("a").alias("id"), F.col("fa").alias("f1")),
                                             F.struct(F.col("b").alias("id"), F.col("fb").alias("f1")))).alias("p"))
        texts = self.texts_of(ids.select("p.*").distinct())
        group = connected_components(pairs.select(F.col("a").alias("u"), F.col("b").alias("v")))
        parts = group.groupBy("comp").agg(F.ceil(F.count(F.lit(1)) / CELL).cast("int").alias("parts"))
        block = stage(group.join(parts, "comp").select(
            "id", F.col("comp").alias("g"), F.pmod(F.xxhash64("id"), "parts").cast("int").alias("block")), "blocks")
        placed = (pairs.select("a", "b").join(block.select(F.col("id").alias("a"), "g", F.col("block").alias("x")), "a")
                  .join(block.select(F.col("id").alias("b"), F.col("block").alias("y")), "b")
                  .select("a", "b", "g", F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y")))
        placed = stage(placed, "placed")
        spots = placed.select(F.explode(F.array("a", "b")).alias("id"), "g", "x", "y").distinct()
        members = texts.join(broadcastable(stage(spots, "spots")), "id").select(
            "g", "x", "y", F.col("id").alias("a"), F.lit(None).cast("long").alias("b"), "text", "f1")
        rows = members.unionByName(placed.select("*", F.lit(None).cast("string").alias("text"),
                                                 F.lit(None).cast("long").alias("f1")))
        rows = rows.repartition("g", "x", "y").sortWithinPartitions("g", "x", "y", F.col("b").asc_nulls_first())

        def make():
            held: dict = {}
            now = [None]

            def per_batch(g, x, y, a, b, text, f1):
                out = []
                for *key, i, j, t, f in zip(g, x, y, a, b, text, f1, strict=True):
                    if key != now[0]:
                        held.clear()
                        now[0] = key
                    if j is None:  # the texts of a group come before its pairs
                        if (own := _own_shingles(t, f, rule)) is not None:
                            held[i] = own
                    else:
                        one, two = held[i], held[j]
                        n = len(np.intersect1d(one, two, assume_unique=True))
                        if rule.den * n >= rule.num * (len(one) + len(two) - n):
                            out.append((i, j))
                return out

            return per_batch, list

        return flat_arrow(rows, make, LINK)

    def texts_of(self, ids: DataFrame) -> DataFrame:
        """(id, text, f1) of the given classes (id, f1)."""
        wanted = stage(ids.join(self.reps.select("id", "doc", "text_hash"), "id"), "pair-ids")
        return self.texts.join(broadcastable(wanted), ["doc", "text_hash"]).select("id", "text", "f1")

    def absorb(self, pairs: DataFrame) -> int:
        """Verify the candidate pairs and contract the links; returns the number of candidates."""
        pairs = stage(self.suffix_filtered(pairs), "pairs")
        n = pairs.count()
        if n:
            self.contract(self.verified(pairs))
        discard(pairs)
        return n

    def contract(self, links: DataFrame) -> None:
        links = stage(links, "links")
        now = links
        for side in ("u", "v"):  # in terms of present components
            now = (now.join(self.comp.withColumnRenamed("id", side), side, "left")
                   .withColumn(side, F.coalesce("comp", side)).drop("comp"))
        merged = connected_components(now).withColumnRenamed("comp", "new")
        old = self.comp.join(merged.withColumnRenamed("id", "comp"), "comp", "left")
        old = old.select("id", F.coalesce("new", "comp").alias("comp"))
        fresh = merged.join(self.comp, "id", "left_anti").select("id", F.col("new").alias("comp"))
        was, self.comp = self.comp, stage(old.unionByName(fresh), "components")
        discard(was)
        discard(links)

    def star_pairs(self, r: int) -> DataFrame:
        """Holders of open shingles paired with the shingle's leaders of round ``r``."""
        held = self.labelled()
        keys = [F.struct(F.xxhash64("id", F.lit(r * LEADERS + i)).alias("h"), F.col("id"), F.col("n"), F.col("pos"),
                         F.col("comp")) for i in range(LEADERS)]
        lead = (held.groupBy("token").agg(F.array(*[F.min(k) for k in keys]).alias("leads"),
                                          F.min("comp").alias("c0"), F.max("comp").alias("c1"))
                .where(F.col("c0") != F.col("c1")).select("token", F.array_distinct("leads").alias("leads")))
        pairs = held.join(lead, "token").select("id", "n", "pos", "comp", F.explode("leads").alias("k"))
        pairs = pairs.where((F.col("comp") != F.col("k.comp")) & _length_ok(F.col("n"), F.col("k.n"), self.rule)
                            & _position_ok(F.col("n"), F.col("pos"), F.col("k.n"), F.col("k.pos"), self.rule))
        return pairs.select(F.least("k.id", "id").alias("a"), F.greatest("k.id", "id").alias("b"))

    def last_pass(self) -> None:
        held = self.labelled()
        tokens = (held.groupBy("token").agg(F.min("comp").alias("c0"), F.max("comp").alias("c1"))
                  .where(F.col("c0") != F.col("c1")))
        held = stage(held.join(tokens.select("token"), "token", "left_semi"), "open")
        cells, pairs = _cells(held, "token")
        rows = cells.join(self.reps.select("id", "ranges"), "id")
        edges = flat_arrow(_by_cell_pair(rows, pairs, ["id", "n", "pos", "comp", "ranges"]), _candidate_edges(self.rule), LINK)
        edges = stage(edges.distinct(), "candidate-edges")
        if not edges.limit(1).count():
            return
        cluster = connected_components(edges).withColumnRenamed("comp", "g")
        members = cluster.join(self.comp, "id", "left").select("id", "g", F.coalesce("comp", "id").alias("comp"))
        cells, pairs = _cells(stage(members, "clusters"), "g")
        texts = self.texts_of(cells.join(self.reps.select("id", "f1"), "id").select("id", "f1").distinct())
        rows = broadcastable(_by_cell_pair(cells, pairs, ["id", "comp"], shuffle=False)).join(texts, "id")
        rows = rows.select("c1", "c2", "side", "id", "comp", "text", "f1")
        rows = rows.repartition("c1", "c2").sortWithinPartitions("c1", "c2")
        self.contract(flat_arrow(rows, _cross_links(self.rule), LINK))


LINK = StructType([StructField("u", LongType()), StructField("v", LongType())])


def _cells(rows: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """The rows of each key cut into cells of about CELL rows, and the pairs
    (c1, c2) of cells to compare: components of CELL rows or more have cells of
    their own, which are not compared with each other; the others share cells."""
    parts = rows.groupBy(key, "comp").agg(F.count(F.lit(1)).alias("m"))
    small = parts.where(F.col("m") < CELL).groupBy(key).agg(F.sum("m").alias("small"))
    sizes = parts.join(small, key, "left").select(
        key, "comp", F.when(F.col("m") >= CELL, F.col("comp")).alias("big"),
        F.when(F.col("m") >= CELL, F.ceil(F.col("m") / CELL)).otherwise(F.ceil(F.col("small") / CELL))
        .cast("long").alias("parts"))
    salt = F.pmod(F.when(F.col("big").isNull(), F.xxhash64("comp")).otherwise(F.xxhash64("id")), F.col("parts"))
    placed = rows.join(sizes, [key, "comp"]).select(*rows.columns, "big", F.xxhash64(key, "big", salt).alias("cell"))
    placed = stage(placed, "cells")
    listed = placed.select(key, "big", "cell").distinct()
    one = listed.select(key, F.col("cell").alias("c1"), F.col("big").alias("b1"))
    two = listed.select(key, F.col("cell").alias("c2"), F.col("big").alias("b2"))
    pairs = one.join(two, key).where((F.col("c1") <= F.col("c2")) & ~F.coalesce(F.col("b1") == F.col("b2"), F.lit(False)))
    return placed, pairs.select("c1", "c2")


def _by_cell_pair(rows: DataFrame, pairs: DataFrame, columns: list[str], shuffle: bool = True) -> DataFrame:
    """The rows of both cells of each pair, side 0 (c1) and side 1 (c2), a pair's rows together."""
    side = F.when(F.col("c1") == F.col("c2"), F.array(F.lit(0))).otherwise(F.array(F.lit(0), F.lit(1)))
    sides = pairs.select("c1", "c2", F.explode(side).alias("side"))
    sides = sides.withColumn("cell", F.when(F.col("side") == 0, F.col("c1")).otherwise(F.col("c2")))
    out = sides.join(rows, "cell").select("c1", "c2", "side", *columns)
    return out.repartition("c1", "c2").sortWithinPartitions("c1", "c2") if shuffle else out


def _own_shingles(text: str, f1: int, rule: Rule) -> np.ndarray | None:
    """The shingles of the text with fingerprint ``f1`` (None: another text under the same id)."""
    s = shingles(text, rule)
    mixed = (s ^ (s >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return s if int(mixed.sum(dtype=np.uint64).view(np.int64)) == f1 else None


class Union:
    """Which of a few ids are already connected."""

    def __init__(self):
        self.root: dict = {}

    def find(self, x):
        while (up := self.root.get(x, x)) != x:
            self.root[x] = x = self.root.get(up, up)
        return x

    def join(self, x, y) -> bool:
        a, b = self.find(x), self.find(y)
        self.root[max(a, b)] = min(a, b)
        return a != b


def _grouped(close):
    """Per-task function over rows sorted by (c1, c2): ``close(same cell?, rows)`` at the end of each pair."""
    key, rows = [None], []

    def end():
        out = close(key[0][0] == key[0][1], rows) if len(rows) > 1 else []
        rows.clear()
        return out

    def per_batch(c1, c2, *cols):
        out = []
        for k1, k2, *r in zip(c1, c2, *cols, strict=True):
            if key[0] != (k1, k2):
                out += end()
                key[0] = (k1, k2)
            rows.append(r)
        return out

    return per_batch, end


def _candidate_edges(rule: Rule):
    """Spanning pairs of the candidate graph of each cell pair."""

    def close(same, rows):
        left = rows if same else [r for r in rows if r[0] == 0]
        right = rows if same else [r for r in rows if r[0] == 1]
        out, known, hist = [], Union(), {}
        size = np.array([len(r[5]) for r in right])
        n, pos, comp = (np.array([r[k] for r in right]) for k in (2, 3, 4))
        for i, (_, x, nx, px, cx, rx) in enumerate(left):
            lo = i + 1 if same else 0
            if lo >= len(right):
                break
            m = n[lo:]
            ok = (comp[lo:] != cx) & (np.minimum(m, nx) * rule.den >= np.maximum(m, nx) * rule.num)
            if not ok.any():
                continue
            q = pos[lo:]
            most = np.minimum(q, px) + 1 + np.minimum(m - q - 1, nx - px - 1)
            at = np.flatnonzero(ok & (most * (rule.num + rule.den) >= (m + nx) * rule.num))
            if not len(at):
                continue
            mine = np.frombuffer(rx, dtype=np.uint8)
            near = []
            for k in np.unique(size[lo:][at]).tolist():  # one matrix for each number of ranges
                if k not in hist:
                    own = np.flatnonzero(size == k)
                    place = np.zeros(len(right), dtype=np.int64)
                    place[own] = np.arange(len(own))
                    hist[k] = place, np.frombuffer(b"".join(right[i][5] for i in own.tolist()),
                                                   dtype=np.uint8).reshape(-1, k)
                place, matrix = hist[k]
                some = at[size[lo:][at] == k]
                near += some[may_link(m[some], nx, matrix[place[lo + some]], mine, rule)].tolist()
            for j in sorted(near):
                y = right[lo + j][1]
                if known.join(x, y):
                    out.append((x, y))
        return out

    return lambda: _grouped(close)


def overlaps(left: list[np.ndarray], right: list[np.ndarray], width: int = 4096) -> np.ndarray:
    """|intersection| of every left and right set, by products of incidence
    matrices over ``width`` shared shingles at a time."""
    sets = left + right
    value, column, held = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    shared = held > (2 if left is right else 1)  # by more than one set
    keep = shared[column]
    number = np.cumsum(shared) - 1  # shared shingles numbered from 0
    row, column = row[keep], number[column[keep]]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    out = np.zeros((len(left), len(right)), dtype=np.float32)
    total = int(number[-1]) + 1 if len(number) else 0
    for lo in range(0, total, width):
        a, b = np.searchsorted(column, (lo, lo + width))
        part = np.zeros((len(sets), width), dtype=np.float32)
        part[row[a:b], column[a:b] - lo] = 1
        out += part[:len(left)] @ part[len(left):].T
    return out.astype(np.int64)


def _cross_links(rule: Rule):
    """Links that connect the components of each cell pair (a spanning set of them)."""

    def close(same, rows):
        sets = [(side, i, c, s) for side, i, c, t, f in rows if (s := _own_shingles(t, f, rule)) is not None]
        sets = list({(side, i): r for r in sets for side, i in [r[:2]]}.values())  # repeated rows once
        left = sets if same else [r for r in sets if r[0] == 0]
        right = sets if same else [r for r in sets if r[0] == 1]
        if not left or not right:
            return []
        one = [r[3] for r in left]
        two = one if same else [r[3] for r in right]
        both = overlaps(one, two)
        na, nb = (np.array([len(s) for s in x]) for x in (one, two))
        link = both >= smallest_overlap(na[:, None], nb[None, :], rule)
        link &= np.array([r[2] for r in left])[:, None] != np.array([r[2] for r in right])[None, :]
        if same:
            link = np.triu(link, 1)
        out, known = [], Union()
        for i, j in np.argwhere(link).tolist():
            if known.join(left[i][2], right[j][2]):
                out.append((left[i][1], right[j][1]))
        return out

    return lambda: _grouped(close)


def link_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rule: Rule = OP6) -> DataFrame:
    """(doc_id, n_shingles, component_id), one row per row of ``docs``."""
    found = labelled_rows(docs, id_col, text_col, rule)
    return found.select(F.col("doc").alias("doc_id"), F.col("n").alias("n_shingles"),
                        F.when(F.col("doc").isNotNull(), F.coalesce("first.doc", "doc")).alias("component_id"))


def labelled_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rule: Rule = OP6) -> DataFrame:
    """(doc, text_hash, n, first), one row per row of ``docs``: ``first`` (doc, text_hash) is the smallest of its
    component, null for rows without shingles or id.  Only what the result reads stays in the shared folder."""
    with staging(docs.sparkSession) as keep:
        texts = docs.select(F.col(id_col).cast("long").alias("doc"), F.xxhash64(text_col).alias("text_hash"),
                            F.col(text_col).alias("text"))
        all_docs = describe(texts, sketch(texts, rule=rule), rule=rule)
        all_docs = stage(all_docs.withColumn("row", F.monotonically_increasing_id()), "described")
        classes = all_docs.where((F.col("n") > 0) & F.col("doc").isNotNull()).groupBy("f1", "f2", "n")
        classes = classes.agg(F.min(F.struct("doc", "text_hash", "row")).alias("least"))
        classes = stage(classes.withColumn("id", F.monotonically_increasing_id()), "classes")
        reps = all_docs.join(classes.select("id", F.col("least.row").alias("row")), "row")  # one row for each class
        reps = stage(reps.select("id", "doc", "text_hash", "n", "f1", "prefix", "ranges"), "representatives")
        run, first = _opened(texts, reps, rule)
        for r in range(STAR_ROUNDS):
            pairs = run.star_pairs(r)
            if not run.absorb((pairs if r else pairs.unionByName(first)).distinct()):
                break
        if not STAR_ROUNDS:  # everything is left to the last pass
            run.absorb(first.distinct())
        run.last_pass()
        named = stage(classes.join(run.comp, "id", "left").select(
            "f1", "f2", "n", F.struct("least.doc", "least.text_hash").alias("least"),
            F.coalesce("comp", "id").alias("comp")), "named")
        rows = stage(all_docs.select("doc", "text_hash", "n", "f1", "f2"), "rows")
        keep += [named, rows]
    least = named.groupBy("comp").agg(F.min("least").alias("first"))
    labels = named.join(least, "comp").select("f1", "f2", "n", "first")
    out = rows.join(labels, ["f1", "f2", "n"], "left")
    return out.select("doc", "text_hash", "n", F.when(F.col("doc").isNotNull(), F.col("first")).alias("first"))


def _opened(texts: DataFrame, reps: DataFrame, rule: Rule) -> tuple["Join", DataFrame]:
    """The run over the shingles with three or more holders, and the pairs (a, b) of those with two.

    The prefix shingles are shuffled once, by shingle, and the window counts their holders there: no list of
    shared shingles, which grows with the corpus, is sent to tasks or joined back."""
    prefixes = reps.select("id", "n", F.posexplode("prefix").alias("pos", "token"))
    held = prefixes.withColumn("c", F.count(F.lit(1)).over(Window.partitionBy("token")))
    holders = stage(held.where(F.col("c") > 1).drop("c"), "holders")
    at = F.struct("id", "n", "pos")
    tokens = stage(holders.groupBy("token").agg(
        F.count(F.lit(1)).alias("c"), F.min(at).alias("lo"), F.max(at).alias("hi"),
        F.bit_xor(F.xxhash64("id")).alias("x"), F.bit_xor(F.xxhash64("id", F.lit(1))).alias("y")), "tokens")
    twos = tokens.where((F.col("c") == 2) & _length_ok(F.col("lo.n"), F.col("hi.n"), rule)
                        & _position_ok(F.col("lo.n"), F.col("lo.pos"), F.col("hi.n"), F.col("hi.pos"), rule))
    # one shingle for each set of three or more holders
    more = tokens.where("c > 2").groupBy("c", "x", "y").agg(F.min("token").alias("token")).select("token")
    run = Join(texts, reps.select("id", "doc", "text_hash", "n", "f1", "ranges"),
               stage(holders.join(broadcastable(stage(more, "open-tokens"), TOKENS), "token"), "open-holders"), rule)
    return run, twos.select(F.col("lo.id").alias("a"), F.col("hi.id").alias("b"))


@shielded
def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rule: Rule = OP6) -> DataFrame:
    """``docs`` with one document of each component (the smallest id); texts
    without shingles and rows without id all stay.  All columns kept.

    Only (id, hash of the text) decide: those to leave out join the documents (sent to every task
    while they are few enough, which is counted), so texts are not shuffled.  An id with several texts is
    judged row by row; repeated rows of a chosen document are copies of it: one of them stays."""
    found = labelled_rows(docs, id_col, text_col, rule).where(F.col("first").isNotNull())
    chosen = F.struct("doc", "text_hash") == F.col("first")
    ids = found.groupBy("doc", "text_hash").agg(F.max(chosen).alias("chosen"), F.count(F.lit(1)).alias("rows"))
    special = ids.where(~F.col("chosen") | (F.col("rows") > 1)).select(
        F.col("doc").alias("__id"), F.col("text_hash").alias("__hash"), "chosen")
    special = stage(special, "not-kept")
    cols = [F.col(f"`{c}`") for c in docs.columns]
    has_words = F.trim(F.coalesce(F.col(f"`{text_col}`"), F.lit("")), F.lit(" \t\n\x0b\x0c\r")) != ""
    keyed = docs.withColumns({"__id": F.when(has_words, F.col(f"`{id_col}`").cast("long")),  # null keys match nothing
                              "__hash": F.xxhash64(F.col(f"`{text_col}`"))})
    key = ["__id", "__hash"]
    single = keyed.join(broadcastable(special.select(*key)), key, "left_anti").select(*cols)
    twice = keyed.join(broadcastable(special.where("chosen").select(*key)), key, "left_semi")
    return single.unionByName(twice.groupBy(*key).agg(F.min(F.struct(*cols)).alias("row")).select("row.*"))


def brute_force(docs, rule: Rule = OP6) -> list[tuple]:
    """Plain all-pairs reference used by the tests: [(id, n, component)]."""
    def of(text):
        w = space_words(text)
        size = min(rule.words, len(w))
        return {tuple(w[i:i + size]) for i in range(len(w) - size + 1)} if w else set()

    sets = [(i, of(t)) for i, t in docs]
    root = {i: i for i, _ in docs}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for p, (i, a) in enumerate(sets):
        for j, b in sets[p + 1:]:
            if a and b and rule.den * len(a & b) >= rule.num * len(a | b):
                x, y = sorted((find(i), find(j)))
                root[y] = x
    return [(i, len(s), find(i)) for i, s in sets]
