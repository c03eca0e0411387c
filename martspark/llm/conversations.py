"""Trie of conversation prefixes by truncation peeling (operator 12).

A conversation is a path of turns from the root; a node is a distinct sequence
of first turns.  Peeling descends from the maximum depth: at each depth the
conversations that end there join the nodes that survive from below, their last
turn is stripped and they are grouped again.  Three things keep the number of
steps and the size of a step bounded:

* Identical conversations are one class with a count.  Their id lists are hashed
  as a stream of sorted pieces, never gathered.
* A prefix has a key of 2 x 64 bits: the xor of the hashes of (position, turn).
  Stripping a turn is one xor, and the key of every prefix comes from a running
  xor in two levels (blocks of ``BLOCK`` turns), so one very long conversation is
  worked on by many tasks.
* Nodes of a single class form a chain whose sums follow from running totals.
  Only nodes shared by several classes are peeled: below ``GROUP`` classes a
  whole subtree is peeled inside one task, rows sorted by depth, with at most
  ``GROUP`` nodes in memory; the few nodes above are peeled depth by depth with
  a shuffle each.

Defined results: null role or text is the empty string; turns are ordered by
turn (null first), then role, then text, and repeated rows are repeated turns;
rows without conv_id belong to no conversation and are left out; an empty table
has no nodes; other columns are ignored.  ``conv_id - conv_id % 100`` rounds
toward zero.
"""

from __future__ import annotations

import hashlib
import zlib

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from ..plans.ranking import keyed_row_number
from ..plans.stage import stage
from .common import flat_arrow

# Fixed values of the rebuilding rule.
FAMILY = 100
MOST_SHARED = 6

BLOCK = 512
GROUP = 256

KEY = ["depth", "k1", "k2"]
_NO_ENDS = hashlib.sha256(b"").hexdigest()


def numbered_turns(conv: DataFrame) -> DataFrame:
    """(conv_id, pos, t1, t2, chars): position, hash and code points of every turn."""
    rows = conv.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"))
    rows = keyed_row_number(rows, ["conv_id"], [F.col("turn").asc_nulls_first(), F.col("role").asc(), F.col("text").asc()],
                            "pos")
    return rows.select("conv_id", F.col("pos").cast("long").alias("pos"), F.xxhash64(F.lit(1), "role", "text").alias("t1"),
                       F.xxhash64(F.lit(2), "role", "text").alias("t2"), F.length("text").cast("long").alias("chars"))


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The conversations (conv_id), and the turns of the rebuilt ones: the first h
    turns of the family's first conversation, then the own turns after h."""
    base = F.col("conv_id") - F.col("conv_id") % FAMILY
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % MOST_SHARED
    lengths = stage(turns.groupBy("conv_id").agg(F.max("pos").alias("length")), "conversations")
    convs = lengths.select("conv_id", base.alias("base"), h.alias("h"))
    first = turns.where(F.col("pos") < MOST_SHARED).withColumnRenamed("conv_id", "base")
    heads = first.join(convs, "base").where(F.col("pos") <= F.col("h"))
    bases = lengths.where(base == F.col("conv_id")).select(F.col("conv_id").alias("base"),
                                                           F.least("length", F.lit(MOST_SHARED)).alias("base_length"))
    tails = (turns.withColumn("h", h).where(F.col("pos") > F.col("h")).withColumn("base", base)
             .join(bases, "base", "left"))
    at = F.col("pos") - F.col("h") + F.least("h", F.coalesce("base_length", F.lit(0)))
    return convs.select("conv_id"), heads.select("conv_id", "pos", "t1", "t2", "chars").unionByName(
        tails.select("conv_id", at.alias("pos"), "t1", "t2", "chars"))


def prefix_keys(turns: DataFrame) -> DataFrame:
    """(conv_id, depth, k1, k2, p1, p2, chars, run): key of every prefix and of
    the one without its last turn, code points of the last turn and of all."""
    t = turns.select("conv_id", F.col("pos").alias("depth"), F.xxhash64("pos", "t1").alias("g1"),
                     F.xxhash64("t2", "pos").alias("g2"), "chars", F.floor((F.col("pos") - 1) / BLOCK).alias("block"))
    inside = Window.partitionBy("conv_id", "block").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    totals = t.groupBy("conv_id", "block").agg(F.bit_xor("g1").alias("g1"), F.bit_xor("g2").alias("g2"),
                                               F.sum("chars").alias("chars"))
    starts = totals.select("conv_id", "block", F.bit_xor("g1").over(before).alias("s1"),
                           F.bit_xor("g2").over(before).alias("s2"), F.sum("chars").over(before).alias("s"))
    started = t.select("*", F.bit_xor("g1").over(inside).alias("x1"), F.bit_xor("g2").over(inside).alias("x2"),
                       F.sum("chars").over(inside).alias("x")).join(starts.where("block > 0"), ["conv_id", "block"], "left")
    k1, k2 = (F.col(f"x{i}").bitwiseXOR(F.coalesce(f"s{i}", F.lit(0))) for i in (1, 2))
    return started.select("conv_id", "depth", k1.alias("k1"), k2.alias("k2"), k1.bitwiseXOR(F.col("g1")).alias("p1"),
                          k2.bitwiseXOR(F.col("g2")).alias("p2"), "chars", (F.col("x") + F.coalesce("s", F.lit(0))).alias("run"))


def hashed_ids(members: DataFrame) -> DataFrame:
    """(depth, k1, k2, ends_sha256) of every key of ``members`` (depth, k1, k2, conv_id): ids
    ascending, comma-joined.  Sorted pieces are joined first, then each key's pieces are hashed one after another."""
    text = StructField("ids", StringType())
    keys = [StructField(k, LongType()) for k in KEY]

    def pieces():
        def per_batch(depth, k1, k2, ids):
            out: list = []
            for *key, i in zip(depth, k1, k2, ids, strict=True):
                if out and out[-1][0] == key:
                    out[-1][2].append(str(i))
                else:
                    out.append((key, i, [str(i)]))
            return [(*key, first, ",".join(found)) for key, first, found in out]

        return per_batch, list

    def digests():
        now: list = [None, None]

        def close():
            key, sha = now
            return [(*key, sha.hexdigest())] if key else []

        def per_batch(depth, k1, k2, ids):
            out = []
            for *key, part in zip(depth, k1, k2, ids, strict=True):
                if key != now[0]:
                    out += close()
                    now[:] = key, hashlib.sha256()
                else:
                    now[1].update(b",")
                now[1].update(part.encode())
            return out

        return per_batch, close

    ordered = members.select(*KEY, "conv_id").repartitionByRange(*KEY, "conv_id").sortWithinPartitions(*KEY, "conv_id")
    parts = flat_arrow(ordered, pieces, StructType([*keys, StructField("first", LongType()), text]))
    parts = parts.repartition(*KEY).sortWithinPartitions(*KEY, "first").select(*KEY, "ids")
    return flat_arrow(parts, digests, StructType([*keys, StructField("ends_sha256", StringType())]))


def peel_groups(nodes: DataFrame) -> DataFrame:
    """Peel whole subtrees, each inside a task.  ``nodes`` has (g, depth, k1, k2, p1, p2) and the node's own
    children, leaves, saved; the result has the sums over its subtree (children: direct ones)."""
    names = ["g", *KEY, "p1", "p2", "children", "leaves", "saved"]

    def make():
        group, at = [None], [None]
        waiting: list[dict] = [{}, {}]  # sums for the nodes of this depth, and for those one turn shorter

        def per_batch(*cols):
            out = []
            for g, d, k1, k2, p1, p2, children, leaves, saved in zip(*cols, strict=True):
                if (g, d) != (group[0], at[0]):
                    waiting[:] = [waiting[1] if g == group[0] else {}, {}]
                    group[0], at[0] = g, d
                c, x, s = waiting[0].get((k1, k2), (0, 0, 0))
                c, x, s = c + children, x + leaves, s + saved
                out.append((g, d, k1, k2, p1, p2, c, x, s))
                pc, px, ps = waiting[1].get((p1, p2), (0, 0, 0))
                waiting[1][p1, p2] = (pc + 1, px + x, ps + s)
            return out

        return per_batch, list

    rows = nodes.select(*names).repartition("g").sortWithinPartitions("g", F.col("depth").desc())
    return flat_arrow(rows, make, StructType([StructField(c, LongType()) for c in names]))


def prefix_trie(conv: DataFrame, group: int = GROUP) -> DataFrame:
    """Nodes of the trie of rebuilt conversations: conv_id (smallest member), depth, parent_conv_id, n_convs,
    n_children, n_leaves, saved_tokens, ends_sha256."""
    turns = stage(numbered_turns(conv), "turns")
    convs, built = rebuilt(turns)
    prefixes = stage(prefix_keys(built), "prefixes")

    # classes of identical conversations, by the key of the whole sequence
    last = F.max(F.struct("depth", "k1", "k2", "run"))
    whole = convs.join(prefixes.groupBy("conv_id").agg(last.alias("e")), "conv_id", "left")
    whole = stage(whole.select("conv_id", *[F.coalesce(f"e.{c}", F.lit(0)).alias(c) for c in (*KEY, "run")]), "whole")
    classes = whole.groupBy(*KEY).agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("m"),
                                      F.max("run").alias("total"))
    classes = stage(classes, "classes")
    several = hashed_ids(whole.join(classes.where("m > 1").select(*KEY), KEY, "left_semi"))
    ends = several.unionByName(classes.where("m = 1").select(*KEY, F.sha2(F.col("conv_id").cast("string"), 256)
                                                             .alias("ends_sha256")))
    paths = prefixes.join(classes.select("conv_id", "m", "total", F.col("depth").alias("length")), "conv_id")

    # nodes: members, classes through them; the last three only mean something for a single class
    nodes = stage(paths.groupBy(*KEY).agg(
        F.min("p1").alias("p1"), F.min("p2").alias("p2"), F.min("chars").alias("chars"), F.min("conv_id").alias("conv_id"),
        F.sum("m").alias("n_convs"), F.count(F.lit(1)).alias("classes"), F.max("run").alias("run"),
        F.max("total").alias("total"), F.max("length").alias("length")), "nodes")
    root = classes.agg(F.min("conv_id").alias("conv_id"), F.sum("m").alias("n_convs"), F.count(F.lit(1)).alias("classes"),
                       F.count(F.when(F.col("depth") > 0, 1)).alias("deep")).first()
    if not root.n_convs:
        return _output(nodes.limit(0).select(
            "conv_id", "depth", F.col("conv_id").alias("parent_conv_id"), "n_convs", F.lit(0).alias("children"),
            F.lit(0).alias("leaves"), F.lit(0).alias("saved"), "k1", "k2"), ends)
    spark = conv.sparkSession
    top = spark.range(1).select(F.lit(0).cast("long").alias("depth"), F.lit(0).cast("long").alias("k1"),
                                F.lit(0).cast("long").alias("k2"), F.lit(root.conv_id).alias("conv_id"),
                                F.lit(root.n_convs).alias("n_convs"), F.lit(root.classes).alias("classes"))

    # chains of a single class: everything below a node is the rest of the conversation
    chains = nodes.where("classes = 1").select(
        "conv_id", *KEY, "p1", "p2", "n_convs", (F.col("depth") < F.col("length")).cast("long").alias("children"),
        F.lit(1).cast("long").alias("leaves"),
        ((F.col("n_convs") - 1) * (F.col("total") - F.col("run") + F.col("chars"))).alias("saved"))
    shared = nodes.where("classes > 1").select(*KEY, "p1", "p2", "conv_id", "n_convs", "classes", "chars")
    parents = shared.select((F.col("depth") + 1).alias("depth"), F.col("k1").alias("p1"), F.col("k2").alias("p2"),
                            F.col("conv_id").alias("parent"))
    # the root is the parent of all nodes of depth 1; chains go on under themselves
    chains = stage(chains.join(parents, ["depth", "p1", "p2"], "left").withColumn(
        "parent_conv_id", F.when(F.col("depth") == 1, F.lit(root.conv_id)).otherwise(F.coalesce("parent", "conv_id")))
        .withColumn("is_head", (F.col("depth") == 1) | F.col("parent").isNotNull()), "chains")
    hung = chains.where("is_head").groupBy((F.col("depth") - 1).alias("depth"), F.col("p1").alias("k1"),
                                           F.col("p2").alias("k2"))
    hung = hung.agg(F.count(F.lit(1)).alias("children"), F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
    shared = (shared.join(parents, ["depth", "p1", "p2"], "left")
              .withColumn("parent_conv_id", F.when(F.col("depth") == 1, F.lit(root.conv_id)).otherwise(F.col("parent")))
              .unionByName(top.withColumns({"p1": F.lit(0).cast("long"), "p2": F.lit(0).cast("long"),
                                            "chars": F.lit(0).cast("long"), "parent": F.lit(None).cast("long"),
                                            "parent_conv_id": F.lit(None).cast("long")})))
    own = [F.coalesce("children", F.lit(0)).alias("children"),
           # a node on which nothing hangs and that nothing shares (a root without turns) is a leaf itself
           (F.coalesce("leaves", F.lit(0)) + F.lit(0 if root.deep else 1)).alias("leaves"),
           (F.coalesce("saved", F.lit(0)) + (F.col("n_convs") - 1) * F.col("chars")).alias("saved")]
    shared = stage(shared.join(hung, KEY, "left").select(
        *KEY, "p1", "p2", "conv_id", "parent_conv_id", "n_convs", "classes", *own), "shared")
    sums = peeled(shared, paths, group)
    done = shared.select(*KEY, "conv_id", "parent_conv_id", "n_convs").join(sums, KEY)
    found = done.unionByName(chains.select(*done.columns))
    return _output(found, ends)


def peeled(shared: DataFrame, paths: DataFrame, group: int) -> DataFrame:
    """(depth, k1, k2, children, leaves, saved) over the subtrees of the shared nodes."""
    hot = shared.where(F.col("classes") > group)
    small = shared.where(F.col("classes") <= group)
    # the smallest conversation of each subtree of at most ``group`` classes names it
    small_keys = small.select(*KEY, "p1", "p2", "conv_id")
    hot_keys = hot.select((F.col("depth") + 1).alias("depth"), F.col("k1").alias("p1"), F.col("k2").alias("p2"))
    tops = small_keys.join(hot_keys, ["depth", "p1", "p2"], "left_semi").unionByName(small_keys.where("depth = 0")
                                                                                     .select("depth", "p1", "p2", "k1", "k2", "conv_id"))
    tops = tops.select(*KEY, F.col("conv_id").alias("g"))
    through = paths.select("conv_id", *KEY)
    if small_keys.where("depth = 0").limit(1).count():  # one small tree
        grouped = small.withColumn("g", F.lit(0).cast("long"))
    else:
        group_of = through.join(tops, KEY).select("conv_id", "g")
        grouped = small.join(group_of, "conv_id")
    peeled_small = stage(peel_groups(grouped), "peeled")
    columns = [*KEY, "children", "leaves", "saved"]
    results = [peeled_small.select(*columns)]
    deepest = hot.agg(F.max("depth").alias("d")).first().d
    below = peeled_small.join(tops, KEY, "left_semi") if deepest is not None else None
    for depth in range(deepest if deepest is not None else -1, -1, -1):
        stripped = below.where(F.col("depth") == depth + 1).groupBy(F.col("p1").alias("k1"), F.col("p2").alias("k2")).agg(
            F.count(F.lit(1)).alias("c"), F.sum("leaves").alias("l"), F.sum("saved").alias("s"))
        level = hot.where(F.col("depth") == depth).join(stripped, ["k1", "k2"], "left").select(
            *KEY, "p1", "p2", (F.col("children") + F.coalesce("c", F.lit(0))).alias("children"),
            (F.col("leaves") + F.coalesce("l", F.lit(0))).alias("leaves"),
            (F.col("saved") + F.coalesce("s", F.lit(0))).alias("saved"))
        level = stage(level, "level")
        results.append(level.select(*columns))
        # what is left of the deeper nodes is in this level's sums
        below = level.unionByName(peeled_small.join(tops, KEY, "left_semi").where(F.col("depth") <= depth)
                                  .select(*level.columns))
    out = results[0]
    for r in results[1:]:
        out = out.unionByName(r)
    return out


def _output(found: DataFrame, ends: DataFrame) -> DataFrame:
    out = found.join(ends, KEY, "left")
    return out.select("conv_id", "depth", "parent_conv_id", "n_convs", F.col("children").cast("long").alias("n_children"),
                      F.col("leaves").cast("long").alias("n_leaves"), F.col("saved").cast("long").alias("saved_tokens"),
                      F.coalesce("ends_sha256", F.lit(_NO_ENDS)).alias("ends_sha256"))


def brute_force(rows) -> list[tuple]:
    """Plain reference for the tests over (conv_id, turn, role, text): every node by itself."""
    own: dict = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(turns)] for c, turns in own.items()}
    built = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % MOST_SHARED
        base = c - (c % FAMILY if c >= 0 else -(-c % FAMILY))
        built[c] = tuple(own.get(base, [])[:h] + turns[h:])
    members: dict = {}
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            members.setdefault(turns[:d], []).append(c)
    out = []
    for node, ids in members.items():
        below = [x for x in members if x[:len(node)] == node]
        childless = [x for x in below if not any(len(y) == len(x) + 1 and y[:len(x)] == x for y in below)]
        ended = sorted(c for c in ids if len(built[c]) == len(node))
        out.append((min(ids), len(node), min(members[node[:-1]]) if node else None, len(ids),
                    sum(len(y) == len(node) + 1 for y in below), len(childless),
                    sum((len(members[x]) - 1) * len(x[-1][1]) for x in below if x),
                    hashlib.sha256(",".join(map(str, ended)).encode()).hexdigest()))
    return out
