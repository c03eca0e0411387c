"""Near duplicates by HyperMinHash (operator 11).

Every distinct shingle falls into one of ``BUCKETS`` buckets.  A bucket keeps its
smallest hash compressed to a register: the number of leading zeros and the next
``MANTISSA`` bits.  0 is an empty bucket.

1. Documents with the same set of shingles are one class; the smallest id stands for it.
2. Banding: ``ROWS`` neighbouring registers make a band, and the classes that agree
   on a band that is not empty hold its key.  At a similarity of 0.85 a pair
   agrees on none of the 25 bands with a probability of 4e-7; small sets fill few
   buckets, and every shared shingle alone in its band is an agreement.
3. Holders of one key are compared with the smallest of them.  A pair is a
   candidate if the Jaccard similarity estimated from the registers, corrected for
   registers that agree by chance, is no more than ``SPREAD`` standard deviations
   below the threshold.
4. Candidates join classes to clusters.  Keys whose holders are still in several
   clusters are compared cell against cell on the registers, which completes the
   clusters: afterwards two classes that share a band and pass the estimate are in
   the same one.
5. Links are confirmed on full shingle sets.  Clusters of up to ``CELL`` classes
   are compared as one cell.  In larger ones every class is first compared with
   one candidate of the best estimate; what then is in different components is
   compared cell against cell, so a group of many thousand near copies costs
   about one comparison each.

Defined results: null and word-less texts have an empty set, link with nothing
and are kept; fewer words than a shingle has are one shingle; a null id links
with nothing, has a null component and is kept; an id with several texts is
judged row by row; repeated rows are copies, and all rows of the smallest id are
kept; tables may be empty; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, DoubleType, LongType, StructField, StructType

from ..plans.stage import stage
from .common import broadcastable, flat_arrow, with_arrow, with_arrow_batches
from .components import connected_components
from .jaccard import LINK, Rule, Union, overlaps, shingles, smallest_overlap

RULE = Rule(words=5, num=85, den=100)

BUCKETS = 128
ROWS = 5
MANTISSA = 11
ZEROS = (1 << (16 - MANTISSA)) - 1  # the most leading zeros that a register of 16 bits can tell
SPREAD = 5.0
CELL = 256
SENT_ROWS = 500_000  # rows of a few longs that may be sent whole to every task

_MIX = np.uint64(0xBF58476D1CE4E5B9)
_MIX2 = np.uint64(0x94D049BB133111EB)
_BUCKET_BITS = BUCKETS.bit_length() - 1


def mixed(s: np.ndarray) -> np.ndarray:
    s = (s ^ (s >> np.uint64(30))) * _MIX
    s = (s ^ (s >> np.uint64(27))) * _MIX2
    return s ^ (s >> np.uint64(31))


def registers(s: np.ndarray) -> np.ndarray:
    """Compressed smallest hash of every bucket: leading zeros, then ``MANTISSA`` bits; 0 is empty.
    Fewer leading zeros give a larger register, so the smallest hash has the smallest register above 0."""
    out = np.zeros(BUCKETS, dtype=np.uint16)
    if not len(s):
        return out
    h = mixed(s)
    bucket = (h & np.uint64(BUCKETS - 1)).astype(np.int64)
    value = h >> np.uint64(_BUCKET_BITS)  # 57 bits
    least = np.full(BUCKETS, np.uint64(2**64 - 1))
    np.minimum.at(least, bucket, value)
    full = np.flatnonzero(np.bincount(bucket, minlength=BUCKETS))
    low, width = least[full], 64 - _BUCKET_BITS
    length = np.zeros(len(full), dtype=np.int64)  # bits of the hash without its leading zeros
    rest = low.copy()
    for step in (32, 16, 8, 4, 2, 1):
        more = (rest >> np.uint64(step)) > 0
        length[more] += step
        rest[more] >>= np.uint64(step)
    length += low > 0
    zeros = np.minimum(width - length, ZEROS)
    # the bits behind the first one (behind the counted zeros where the count is at its limit)
    at = np.maximum(width - zeros - 1, MANTISSA)
    bits = ((low >> (at - MANTISSA).astype(np.uint64)) & np.uint64((1 << MANTISSA) - 1)).astype(np.int64)
    out[full] = np.maximum(((ZEROS - zeros) << MANTISSA) | bits, 1)
    return out


def band_keys(r: np.ndarray) -> list[list[int]]:
    """Keys of the bands that are not empty, for each row of registers."""
    bands = r[:, :BUCKETS // ROWS * ROWS].reshape(len(r), -1, ROWS).astype(np.uint64)
    h = np.broadcast_to(np.arange(1, bands.shape[1] + 1, dtype=np.uint64) * _MIX, bands.shape[:2])
    for i in range(ROWS):
        h = mixed(h ^ (bands[:, :, i] + np.uint64(1)))
    return [k[full].tolist() for k, full in zip(h.view(np.int64), bands.any(axis=2), strict=True)]


def chance_agreement(na: np.ndarray, nb: np.ndarray) -> np.ndarray:
    """Probability that two full buckets of unrelated sets of these sizes have the same register.

    The smallest of n/BUCKETS uniform numbers is above x with probability exp(-x n/BUCKETS).  Registers with
    i leading zeros cut (2^-i-1, 2^-i) into 2^MANTISSA equal cells; over the cells the chances that both
    sets' smallest numbers fall into the same one form a geometric series."""
    a, b = (np.maximum(n, 1)[:, None].astype(float) / BUCKETS for n in (na, nb))
    i = np.arange(ZEROS + 1)[None, :].astype(float)
    start = np.where(i < ZEROS, 2.0 ** -(i + 1), 0.0)  # the last level reaches down to zero
    cell = np.where(i < ZEROS, 2.0 ** -(i + 1), 2.0 ** -ZEROS) / (1 << MANTISSA)
    both = a + b
    series = np.expm1(-both * cell * (1 << MANTISSA)) / np.expm1(-both * cell)
    same = np.exp(-both * start) * np.expm1(-a * cell) * np.expm1(-b * cell) * series
    full = np.expm1(-a) * np.expm1(-b)  # both buckets hold something
    return np.clip(same.sum(axis=1) / full[:, 0], 0, 0.5)


def estimate(na: np.ndarray, nb: np.ndarray, ra: np.ndarray, rb: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Collision-corrected Jaccard similarity of each pair (register rows), and the number of buckets it rests on."""
    used = ((ra > 0) | (rb > 0)).sum(axis=1)
    agree = ((ra == rb) & (ra > 0)).sum(axis=1)
    by_chance = chance_agreement(na, nb)
    share = agree / np.maximum(used, 1)
    return (share - by_chance) / (1 - by_chance), used


def may_link(na, nb, ra, rb, rule: Rule = RULE) -> tuple[np.ndarray, np.ndarray]:
    """Which pairs pass the length filter and the estimate, and the estimates."""
    t = rule.num / rule.den
    similar, used = estimate(na, nb, ra, rb)
    # at most as many buckets differ as shingles do: exact for small sets, where the deviation says nothing
    apart = na + nb - 2 * smallest_overlap(na, nb, rule)
    differ = ((ra != rb) & ((ra > 0) | (rb > 0))).sum(axis=1)
    low = t - SPREAD * np.sqrt(t * (1 - t) / np.maximum(used, 1))
    long_enough = np.minimum(na, nb) * rule.den >= np.maximum(na, nb) * rule.num
    return long_enough & (differ <= apart) & (similar >= low), similar


def fingerprints(s: np.ndarray) -> tuple[int, int]:
    m = mixed(s ^ np.uint64(0x5851F42D4C957F2D))
    return int(m.sum(dtype=np.uint64).view(np.int64)), int(np.bitwise_xor.reduce(m * _MIX2 ^ s).view(np.int64))


def describe(texts: DataFrame, rule: Rule = RULE) -> DataFrame:
    """``texts`` without text, with n, f1, f2, regs: size, fingerprint and registers of every text's set."""

    def make():
        def one(text):
            s = shingles(text, rule)
            if not len(s):
                return 0, 0, 0, b""
            return (len(s), *fingerprints(s), registers(s).tobytes())

        return one

    return with_arrow(texts, ["text"], make, [StructField("n", LongType()), StructField("f1", LongType()),
                                              StructField("f2", LongType()), StructField("regs", BinaryType())]).drop("text")


def _rows(regs: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(regs), dtype=np.uint16).reshape(len(regs), BUCKETS)


def holders_of(reps: DataFrame) -> DataFrame:
    """(v, key): the band keys of every class."""

    def make():
        return lambda regs: [band_keys(_rows(regs))]

    keyed = with_arrow_batches(reps.select("v", "regs"), ["regs"], make, [StructField("keys", ArrayType(LongType()))])
    return keyed.select("v", F.explode("keys").alias("key"))


def scored(pairs: DataFrame, reps: DataFrame, rule: Rule) -> DataFrame:
    """The candidates (a, b, similar) among the pairs (a, b)."""
    for side in ("a", "b"):
        pairs = pairs.join(reps.select(F.col("v").alias(side), F.col("n").alias(f"n{side}"),
                                       F.col("regs").alias(f"r{side}")), side)

    def make():
        def each(na, nb, ra, rb):
            ok, similar = may_link(np.array(na), np.array(nb), _rows(ra), _rows(rb), rule)
            return [[s if o else None for o, s in zip(ok.tolist(), similar.tolist(), strict=True)]]

        return each

    out = with_arrow_batches(pairs, ["na", "nb", "ra", "rb"], make, [StructField("similar", DoubleType())])
    return out.where(F.col("similar").isNotNull()).select("a", "b", "similar")


def cells_of(rows: DataFrame, key: str, cell: int) -> tuple[DataFrame, DataFrame]:
    """``rows`` (key, part, v, ..) cut into cells of about ``cell`` rows, and the pairs of cells (c1, c2) to
    compare.  Parts of ``cell`` rows or more have their own cells, which are not compared with each other."""
    sizes = rows.groupBy(key, "part").agg(F.count(F.lit(1)).alias("m"))
    own = F.col("m") >= cell
    few = sizes.where(~own).groupBy(key).agg(F.sum("m").alias("few"))
    sizes = sizes.join(few, key, "left").select(
        key, "part", F.when(own, F.col("part")).alias("big"),
        F.ceil(F.when(own, F.col("m")).otherwise(F.col("few")) / cell).cast("long").alias("cells"))
    at = F.pmod(F.when(F.col("big").isNull(), F.xxhash64("part")).otherwise(F.xxhash64("v")), F.col("cells"))
    placed = stage(rows.join(sizes, [key, "part"]).withColumn("cell", F.xxhash64(key, "big", at)).drop("cells"), "cells")
    listed = placed.select(key, "big", "cell").distinct()
    left = listed.select(key, F.col("cell").alias("c1"), F.col("big").alias("b1"))
    right = listed.select(key, F.col("cell").alias("c2"), F.col("big").alias("b2"))
    pairs = left.join(right, key).where((F.col("c1") <= F.col("c2")) & ~F.coalesce(F.col("b1") == F.col("b2"), F.lit(False)))
    return placed.drop("big"), pairs.select("c1", "c2")


def compared_cells(rows: DataFrame, pairs: DataFrame, payload: DataFrame, link) -> DataFrame:
    """Links (u, v) found by ``link(left rows, right rows or None)`` on every pair of cells of
    ``rows`` (cell, v, part).  A row of a cell is v, part and what ``payload`` has for v, which is sent last."""
    sides = pairs.select("c1", "c2", F.explode(F.when(F.col("c1") == F.col("c2"), F.array(F.lit(0)))
                                               .otherwise(F.array(F.lit(0), F.lit(1)))).alias("side"))
    sides = sides.withColumn("cell", F.when(F.col("side") == 0, F.col("c1")).otherwise(F.col("c2")))
    carried = [c for c in payload.columns if c != "v"]
    together = (sides.join(rows.select("cell", "v", "part"), "cell").join(payload, "v")
                .select("c1", "c2", "side", "v", "part", *carried)
                .repartition("c1", "c2").sortWithinPartitions("c1", "c2"))

    def make():
        now, held = [None], []

        def close():
            out = []
            if len(held) > 1:
                left = [r[1:] for r in held if r[0] == 0]
                right = [r[1:] for r in held if r[0] == 1] if now[0][0] != now[0][1] else None
                out = link(left, right) if left and (right is None or right) else []
            held.clear()
            return out

        def per_batch(c1, c2, *cols):
            out = []
            for x, y, *row in zip(c1, c2, *cols, strict=True):
                if (x, y) != now[0]:
                    out += close()
                    now[0] = (x, y)
                held.append(row)
            return out

        return per_batch, close

    return flat_arrow(together, make, LINK)


def _spanning(left, right, ok, u, v, known: Union, part) -> list[tuple]:
    """Those of the pairs ``ok`` (index arrays) that connect parts not yet connected."""
    return [(left[i][u], right[j][v]) for i, j in zip(*ok, strict=True) if known.join(left[i][part], right[j][part])]


def register_candidates(rule: Rule):
    """Spanning candidates of rows (v, part, n, regs) of different parts."""

    def link(left, right):
        same, right = right is None, left if right is None else right
        n, part, regs = np.array([r[2] for r in right]), np.array([r[1] for r in right]), _rows([r[3] for r in right])
        out, known = [], Union()
        for i, (_, mine, size, reg) in enumerate(left):
            lo = i + 1 if same else 0
            other = lo + np.flatnonzero(part[lo:] != mine)
            if not len(other):
                continue
            ok, _ = may_link(np.full(len(other), size), n[other], np.broadcast_to(_rows([reg]), (len(other), BUCKETS)),
                             regs[other], rule)
            out += _spanning(left, right, ([i] * int(ok.sum()), other[ok].tolist()), 0, 0, known, 1)
        return out

    return link


def set_links(rule: Rule):
    """Spanning links of rows (v, part, text) of different parts, on full sets."""

    def link(left, right):
        same, right = right is None, left if right is None else right
        one = [shingles(r[2], rule) for r in left]
        two = one if same else [shingles(r[2], rule) for r in right]
        na, nb = (np.array([len(s) for s in x]) for x in (one, two))
        ok = overlaps(one, two) >= smallest_overlap(na[:, None], nb[None, :], rule)
        ok &= np.array([r[1] for r in left])[:, None] != np.array([r[1] for r in right])[None, :]
        ok = np.argwhere(np.triu(ok, 1) if same else ok).T.tolist() or ([], [])
        return _spanning(left, right, ok, 0, 0, Union(), 1)

    return link


class NearDuplicates:
    """The steps of one run.  ``texts`` has (id, text_hash, text), ``reps`` one row (v, id, text_hash, n, regs)
    for each class, with the smallest id that has it."""

    def __init__(self, texts: DataFrame, reps: DataFrame, rule: Rule, cell: int):
        self.texts, self.reps, self.rule, self.cell = texts, reps, rule, cell

    def class_texts(self, wanted: DataFrame) -> DataFrame:
        """(v, text) of the classes ``wanted`` (v), each once: one text of the class's smallest id."""
        ids = stage(self.reps.join(wanted, "v", "left_semi").select("v", "id", "text_hash"), "wanted")
        found = self.texts.join(broadcastable(ids, SENT_ROWS), ["id", "text_hash"])
        return found.select("v", "text").dropDuplicates(["v"])

    def clusters(self) -> tuple[DataFrame, DataFrame]:
        """The candidates (a, b, similar) with the smallest holder, and (v, cluster) of every class with candidates."""
        holders = stage(holders_of(self.reps), "band-holders")
        keys = holders.groupBy("key").agg(F.count(F.lit(1)).alias("c"), F.min("v").alias("lo"), F.max("v").alias("hi"),
                                          F.bit_xor(F.xxhash64("v")).alias("x")).where("c > 1")
        keys = stage(keys, "band-keys")
        # one key for each set of three or more holders
        more = keys.where("c > 2").groupBy("c", "lo", "hi", "x").agg(F.min("key").alias("key")).select("key", "lo")
        held = stage(holders.join(broadcastable(stage(more, "open-keys"), SENT_ROWS), "key").select("key", "v", "lo"), "open-holders")
        pairs = (keys.where("c = 2").select(F.col("lo").alias("a"), F.col("hi").alias("b"))
                 .unionByName(held.where(F.col("v") != F.col("lo")).select(F.col("lo").alias("a"), F.col("v").alias("b")))
                 .distinct())
        found = stage(scored(pairs, self.reps, self.rule), "candidates")
        label = stage(connected_components(found.select(F.col("a").alias("u"), F.col("b").alias("v"))), "clusters")
        label = label.select(F.col("id").alias("v"), "comp")
        rows = held.select("key", "v").join(label, "v", "left").select("key", "v", F.coalesce("comp", "v").alias("part"))
        several = rows.groupBy("key").agg(F.min("part").alias("a"), F.max("part").alias("b")).where("a != b")
        rows = stage(rows.join(several.select("key"), "key", "left_semi"), "split-keys")
        placed, cell_pairs = cells_of(rows, "key", self.cell)
        edges = compared_cells(placed, cell_pairs, self.reps.select("v", "n", "regs"), register_candidates(self.rule))
        edges = stage(found.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(edges), "edges")
        return found, stage(connected_components(edges).select(F.col("id").alias("v"), F.col("comp").alias("cluster")),
                            "clusters")

    def leader_links(self, found: DataFrame, large: DataFrame) -> DataFrame:
        """Confirmed links of the classes in large clusters with their best candidate: the
        classes of one leader in chunks of ``cell``, the leader's set read once for each chunk."""
        rule = self.rule
        ways = F.explode(F.array(F.struct(F.col("a").alias("v"), F.col("b").alias("leader")),
                                 F.struct(F.col("b").alias("v"), F.col("a").alias("leader"))))
        # a leader is the smaller class of the pair: chains of leaders cannot turn in circles
        best = (found.select("similar", ways.alias("w")).select("similar", "w.*").where(F.col("leader") < F.col("v"))
                .join(large, "v", "left_semi").groupBy("v")
                .agg(F.max(F.struct("similar", (-F.col("leader")).alias("least"))).alias("m"))
                .select("v", (-F.col("m.least")).alias("leader")))
        best = stage(best, "leaders")
        sizes = best.groupBy("leader").agg(F.ceil(F.count(F.lit(1)) / self.cell).cast("long").alias("chunks"))
        placed = best.join(sizes, "leader").select("leader", "v", F.pmod(F.xxhash64("v"), "chunks").alias("chunk"))
        rows = stage(placed.unionByName(placed.select("leader", F.col("leader").alias("v"), "chunk").distinct()), "chunks")
        texts = self.class_texts(rows.select("v").distinct())
        rows = rows.join(texts, "v").withColumn("member", F.col("v") != F.col("leader"))
        rows = rows.repartition("leader", "chunk").sortWithinPartitions("leader", "chunk", "member")

        def make():
            now, own = [None], [None]

            def per_batch(leader, chunk, member, v, text):
                out = []
                for x, c, m, i, t in zip(leader, chunk, member, v, text, strict=True):
                    s = shingles(t, rule)
                    if not m:  # the leader comes first
                        now[0], own[0] = (x, c), s
                    elif now[0] == (x, c):
                        both = len(np.intersect1d(own[0], s, assume_unique=True))
                        if rule.den * both >= rule.num * (len(s) + len(own[0]) - both):
                            out.append((x, i))
                return out

            return per_batch, list

        return flat_arrow(rows.select("leader", "chunk", "member", "v", "text"), make, LINK)

    def components(self) -> DataFrame:
        """(v, comp) of every class with a confirmed link."""
        found, cluster = self.clusters()
        sizes = cluster.groupBy("cluster").agg(F.count(F.lit(1)).alias("size"))
        large = cluster.join(sizes.where(F.col("size") > self.cell), "cluster", "left_semi")
        first = stage(self.leader_links(found, large.select("v")), "links")
        parts = stage(connected_components(first).select(F.col("id").alias("v"), F.col("comp").alias("part")), "parts")
        rows = cluster.join(parts, "v", "left").select("cluster", "v", F.coalesce("part", "v").alias("part"))
        open_ = rows.groupBy("cluster").agg(F.min("part").alias("a"), F.max("part").alias("b")).where("a != b")
        rows = stage(rows.join(open_.select("cluster"), "cluster", "left_semi"), "open-clusters")
        placed, pairs = cells_of(rows, "cluster", self.cell)
        rest = compared_cells(placed, pairs, self.class_texts(rows.select("v").distinct()), set_links(self.rule))
        links = stage(first.unionByName(rest), "links")
        return connected_components(links).select(F.col("id").alias("v"), "comp")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rule: Rule = RULE,
                    cell: int = CELL) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept), one row per row of ``docs``."""
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text_col).alias("text_hash"),
                        F.col(text_col).alias("text"))
    described = stage(describe(texts, rule), "described")
    same = described.where((F.col("n") > 0) & F.col("id").isNotNull()).groupBy("f1", "f2", "n", "regs")
    reps = same.agg(F.min(F.struct("id", "text_hash")).alias("least")).select("f1", "f2", "n", "regs", "least.*")
    reps = stage(reps.withColumn("v", F.monotonically_increasing_id()), "classes")
    comp = NearDuplicates(texts, reps, rule, cell).components()
    named = stage(reps.select("v", "f1", "f2", "n", "id").join(comp, "v", "left")
                  .select("f1", "f2", "n", "id", F.coalesce("comp", "v").alias("comp")), "named")
    least = named.groupBy("comp").agg(F.min("id").alias("component"))
    labels = named.join(least, "comp").select("f1", "f2", "n", "component")
    out = described.select("id", "n", "f1", "f2").join(labels, ["f1", "f2", "n"], "left")
    component = F.when(F.col("id").isNotNull(), F.coalesce("component", "id"))
    return out.select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), component.alias("component_id"),
                      F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"))
