"""Mixing sources to target weights (operator 1, DataFrame functions only).

1. Size of each document = its words; each source's words form one stream in
   the order (bucket of the id, id).  Stream offsets are prefix sums in two
   levels: inside a (source, bucket) and over the buckets of a source.  With
   about sqrt(rows) buckets both levels stay short, also for a source that
   holds a third of the rows.
2. The stream is packed into blocks of ``block_words`` words (the last one may
   be short).  Targets come from the weights with no source above
   ``max_repeats`` times its size (water filling), and give each source its
   number of slots: whole passes over its blocks plus a part of one more.
3. Every output shard draws its slots' sources at random by target weight, so
   its source counts are multinomial.  Draws beyond a source's slots are cut
   and missing ones go to a last, settling shard, so each source ends exactly
   at its target.
4. Slot g of a source is pass g div blocks, position g mod blocks; the position
   is mapped to a block by a pseudorandom permutation of that source and pass
   (swap-or-not shuffle: bijective for every number of blocks, needs no table).
5. Slots are joined with the documents' block pieces by (source, block).

All randomness is md5 of the seed and the slot, so reruns agree.

Every shuffle is keyed by block, by (source, bucket) or by shard; nothing of a
source is gathered in one task.  The driver sees one row per source.

Defined results: null text has size 0 and is never taken; a null source is a
source of its own, after all others; repeated rows are separate documents; no
documents, or none with words, give no draws.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..plans.stage import stage

BLOCK_WORDS = 256
SHARDS = 64
MAX_REPEATS = 3
WEIGHTS = (1, 2, 3)
SEED = 17
ROUNDS = 24
MAX_SOURCES = 10_000
_CHUNK = 4096
_SLOTS_PER_TASK = 16_384


def hash52(*parts) -> Column:
    """A 52-bit number from the md5 of the parts."""
    text = F.concat_ws(":", *[p if isinstance(p, Column) else F.lit(str(p)) for p in parts])
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 13), 16, 10).cast("long")


def document_sizes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   source_col: str = "source") -> DataFrame:
    size = F.coalesce(F.regexp_count(F.col(text_col), F.lit(r"[^ \t-\x0D]+")), F.lit(0)).cast("long")
    return docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), size.alias("size"))


def source_targets(sizes: DataFrame, weights=WEIGHTS, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """(source, src, source_size, target): one row per source.

    A source is capped when its share by weight exceeds ``max_repeats`` times
    its size.  Taken in the order of cap per weight, the capped sources are the
    first ones, up to the first source whose share of what is left fits."""
    by = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    # windows over one row per source (at most MAX_SOURCES)
    numbered = by.select("*", (F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1).alias("src"))
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), F.col("src") % len(weights) + 1)
    d = numbered.select("*", w.alias("w"), (F.lit(float(max_repeats)) * F.col("source_size")).alias("cap"),
                        F.sum("source_size").over(Window.partitionBy()).cast("double").alias("total"))
    order = Window.orderBy(F.col("cap") / F.col("w"), "src")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    after = order.rowsBetween(0, Window.unboundedFollowing)
    d = d.select("*", F.row_number().over(order).alias("rank"),
                 ((F.col("total") - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("w").over(after))
                 .alias("level"))
    fits = F.min(F.when(F.col("level") * F.col("w") <= F.col("cap"), F.col("rank"))).over(Window.partitionBy())
    d = d.select("*", fits.alias("first"))
    level = F.max(F.when(F.col("rank") == F.col("first"), F.col("level"))).over(Window.partitionBy())
    return d.select("source", "src", "source_size",
                    F.when(F.col("rank") < F.col("first"), F.col("cap"))
                    .otherwise(F.coalesce(F.least(level * F.col("w"), F.col("cap")), F.lit(0.0))).alias("target"))


def slot_plan(targets: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """Adds blocks, slots and the words of the last slot (null: a whole block)."""
    d = targets.select("*", F.ceil(F.col("source_size") / block_words).cast("long").alias("blocks"))
    passes = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    rest = F.round(F.col("target") - passes * F.col("source_size")).cast("long")
    d = d.select("*", passes.cast("long").alias("passes"), rest.alias("rest"))
    part = F.ceil(F.col("rest") / block_words).cast("long")
    d = d.select("*", (F.col("passes") * F.col("blocks") + part).alias("slots"),
                 F.when(F.col("rest") > 0, F.col("rest") - (part - 1) * block_words).alias("last_words"))
    return d.drop("passes", "rest")


def packed(sizes: DataFrame, targets: DataFrame) -> DataFrame:
    """``sizes`` with src, row key (bucket, rn) and the stream offset."""
    n = max(1, sizes.count())
    buckets = math.ceil(math.sqrt(n))
    keyed = sizes.join(F.broadcast(targets.select(F.col("source").alias("__s"), "src")),  # MAX_SOURCES rows
                       F.col("source").eqNullSafe(F.col("__s"))).drop("__s")
    keyed = keyed.select("*", F.pmod(hash52(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), F.lit(buckets))
                         .alias("bucket"))
    totals = keyed.groupBy("src", "bucket").agg(F.sum("size").alias("words"))
    earlier = Window.partitionBy("src").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    base = totals.select("src", "bucket", F.coalesce(F.sum("words").over(earlier), F.lit(0)).alias("base"))
    inside = Window.partitionBy("src", "bucket").orderBy("doc_id", "size")
    local = keyed.select("*", F.row_number().over(inside).alias("rn"),
                         F.coalesce(F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
                         .alias("local"))
    return local.join(base, ["src", "bucket"]).select(
        "doc_id", "source", "size", "src", "bucket", "rn", (F.col("base") + F.col("local")).alias("offset"))


def draw_slots(spark, plan: list, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """(shard, src, g): the shard that each slot g of each source went to.

    ``plan``: rows (src, slots), one per source."""
    total = sum(r["slots"] for r in plan)
    bounds, run = [], 0
    for r in plan:
        run += r["slots"]
        bounds.append(run)
    u = (hash52(seed, "draw", F.col("id").cast("string")).cast("double") / F.lit(float(2 ** 52)))
    drawn = F.floor(u * F.lit(float(total))).cast("long")
    ends = F.array(*[F.lit(b).cast("long") for b in bounds]) if bounds else F.array().cast("array<long>")
    counts = (spark.range(total).select((F.col("id") % shards).alias("shard"), drawn.alias("x"))
              .select("shard", F.size(F.filter(ends, lambda e: e <= F.col("x"))).alias("src"))
              .groupBy("shard", "src").agg(F.count(F.lit(1)).alias("n")))
    # at most shards rows per source
    before = Window.partitionBy("src").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    slots = F.element_at(F.array(*[F.lit(r["slots"]).cast("long") for r in plan] or [F.lit(0).cast("long")]),
                         F.col("src") + 1)
    runs = counts.select("shard", "src", "n", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"),
                         slots.alias("slots"))
    # the settling shard takes what the draws left over
    listed = spark.range(len(plan)).select(F.col("id").cast("int").alias("src"))
    settle = (listed.join(runs.groupBy("src").agg(F.sum("n").alias("drawn")), "src", "left")
              .select(F.lit(shards).cast("long").alias("shard"), "src", F.coalesce("drawn", F.lit(0)).alias("first"),
                      slots.alias("slots")))
    parts = (runs.select("shard", "src", "first", F.least(F.col("first") + F.col("n"), F.col("slots")).alias("end"))
             .unionByName(settle.select("shard", "src", "first", F.col("slots").alias("end")))
             .where(F.col("first") < F.col("end")))
    # two steps, so that no row holds more than a chunk of slots and the chunks spread
    last_chunk = F.floor((F.col("end") - F.col("first") - 1) / _CHUNK).cast("long")
    chunks = parts.select("shard", "src", "first", "end",
                          F.explode(F.sequence(F.lit(0).cast("long"), last_chunk)).alias("c"))
    start = F.col("first") + F.col("c") * _CHUNK
    # the rows are few and short but each stands for many slots: the number of
    # tasks follows the slots, not the bytes
    return (chunks.repartition(max(1, math.ceil(total / _SLOTS_PER_TASK)), "src", "c", "shard")
            .select("shard", "src",
                    F.explode(F.sequence(start, F.least(start + _CHUNK, F.col("end")) - 1)).alias("g")))


def permuted(position: Column, blocks: Column, src: Column, pass_: Column, seed: int = SEED,
             rounds: int = ROUNDS) -> Column:
    """Block of ``position`` under the swap-or-not permutation of (src, pass_)."""
    key = F.concat_ws(":", F.lit(str(seed)), src.cast("string"), pass_.cast("string"))

    def step(x: Column, r: Column) -> Column:
        partner = F.pmod(hash52(key, r.cast("string")) - x, blocks)
        high = F.greatest(x, partner)
        swap = F.substring(F.md5(F.concat_ws(":", key, r.cast("string"), high.cast("string")).cast("binary")), 1, 1)
        return F.when(swap >= "8", partner).otherwise(x)

    return F.aggregate(F.sequence(F.lit(1), F.lit(rounds)), position, step)


def block_slots(spark, plan: list, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """(shard, src, g, block, words): ``words`` is null where the whole block is taken."""
    slots = draw_slots(spark, plan, shards, seed)

    def of(field: str) -> Column:
        values = [F.lit(r[field]).cast("long") for r in plan] or [F.lit(None).cast("long")]
        return F.element_at(F.array(*values), F.col("src") + 1)

    d = slots.select("*", of("blocks").alias("blocks"))
    block = permuted(F.col("g") % F.col("blocks"), F.col("blocks"), F.col("src"),
                     F.floor(F.col("g") / F.col("blocks")).cast("long"), seed)
    return d.select("shard", "src", "g", block.alias("block"),
                    F.when(F.col("g") == of("slots") - 1, of("last_words")).alias("words"))


def mix(docs: DataFrame, weights=WEIGHTS, block_words: int = BLOCK_WORDS, shards: int = SHARDS, seed: int = SEED,
        max_repeats: int = MAX_REPEATS) -> DataFrame:
    """doc_id, size, source_size, target, taken: one row per document."""
    spark = docs.sparkSession
    sizes = stage(document_sizes(docs), "mix-sizes")
    targets = stage(source_targets(sizes, weights, max_repeats), "mix-targets")
    plan = slot_plan(targets, block_words).orderBy("src").limit(MAX_SOURCES + 1).collect()
    if len(plan) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    taken = (block_slots(spark, plan, shards, seed).groupBy("src", "block")
             .agg(F.count_if(F.col("words").isNull()).alias("whole"), F.max("words").alias("part")))
    rows = packed(sizes, targets)
    first = F.floor(F.col("offset") / block_words).cast("long")
    last = F.floor((F.col("offset") + F.col("size") - 1) / block_words).cast("long")
    pieces = rows.select("*", F.explode(F.when(F.col("size") > 0, F.sequence(first, last))
                                        .otherwise(F.array(F.lit(-1).cast("long")))).alias("block"))
    start = F.greatest(F.col("offset") - F.col("block") * block_words, F.lit(0))
    end = F.least(F.col("offset") + F.col("size") - F.col("block") * block_words, F.lit(block_words))
    pieces = pieces.select("doc_id", "size", "src", "bucket", "rn", "block", start.alias("start"), end.alias("end"))
    # one row per drawn block: grows with the corpus, so never broadcast
    joined = pieces.join(taken.hint("merge"), ["src", "block"], "left")
    words = (F.coalesce("whole", F.lit(0)) * (F.col("end") - F.col("start"))
             + F.greatest(F.least(F.col("end"), F.coalesce("part", F.lit(0))) - F.col("start"), F.lit(0)))
    out = (joined.groupBy("src", "bucket", "rn", "doc_id", "size")
           .agg(F.sum(F.when(F.col("block") >= 0, words).otherwise(0)).alias("taken")))
    return (out.join(F.broadcast(targets.select("src", "source_size", "target")), "src")
            .select("doc_id", "size", "source_size", "target", "taken"))
