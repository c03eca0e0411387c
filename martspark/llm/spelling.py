"""Spelling variants by reduced-alphabet generation (operator 13).

Words are the letter runs of all texts with their counts over the whole corpus.
Two words are near if one code point inserted, deleted or replaced turns one
into the other.

1. Letters are hashed to a few symbols.  Words that are near have reduced words
   that are near or equal.
2. Every distinct reduced word generates its full one-edit neighbourhood
   (itself, replacements, insertions, deletions), as rolling hashes, so that a
   neighbour costs the same at any word length.
3. The neighbours join the reduced vocabulary.  A bitmap of fixed size with the
   hashes of the reduced vocabulary drops most neighbours without a word before
   the shuffle.
4. Pairs are verified on the original strings.

The number of symbols is chosen for each word length from the vocabulary itself:
the smallest alphabet of the ladder whose reduced words stand for few words each
(``BUCKET_MEAN`` and ``BUCKET_MAX``).  The last alphabet of the ladder keeps all
letters apart, where a reduced word stands for one word only, so a group of
words that share a reduced word is bounded whatever the words are.  Lengths of
``LONG`` and more choose together.  A pair of lengths L and L + 1 meets in the
alphabet of L.

A word's form is its most frequent near word (ties: the smallest in code-point
order), if that is at least twice as frequent; roots follow forms to the last by
pointer doubling.  Counts at least double on every step, so a chain has at most
log2(largest count) links.

Defined results: null and empty texts have no words; a null id counts as an
empty string in the hash that picks the deleted letters; repeated rows count as
often as they occur; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from ..plans.stage import discard, stage
from .common import flat_arrow

# Fixed values of the word definition: letters, and which of their runs lose a code point.
LETTERS = "".join(map(chr, range(ord("a"), ord("z") + 1))) + "".join(map(chr, range(0xC0, 0x100)))
RUN = re.compile("[A-Za-zÀ-ÿ]+")
LOSES_ONE_IN = 97
MIN_LENGTH = 5
MIN_COUNT = 3

LADDER = (2, 4, 8, 16, 32, len(LETTERS))
BUCKET_MEAN = 8
BUCKET_MAX = 256
LONG = 64
HELD_WORDS = 200_000    # distinct words that a task counts before it passes them on
FILTER_BITS = 24
CHUNK = 1 << 20         # neighbours generated at a time

_BASE = np.uint64(0x9E3779B97F4A7C15)  # odd
_MIX = np.uint64(0xBF58476D1CE4E5B9)


def lower_ascii(text: str) -> str:
    return text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")


def seen_word(doc_id, run: str) -> str:
    """The run as it counts: without one code point where the hash of document and run says so."""
    h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode("utf-8", "surrogatepass"))
    if h % LOSES_ONE_IN:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1:]


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, n) over all documents, before any minimum."""

    def make():
        held: Counter = Counter()

        def drain():
            out = list(held.items())
            held.clear()
            return out

        def per_batch(ids, texts):
            out = []
            for i, text in zip(ids, texts, strict=True):
                for run, n in Counter(RUN.findall(lower_ascii(text or ""))).items():
                    held[seen_word(i, run)] += n
                if len(held) > HELD_WORDS:
                    out += drain()
            return out

        return per_batch, drain

    found = flat_arrow(docs.select(id_col, text_col), make,
                       StructType([StructField("word", StringType()), StructField("n", LongType())]))
    return found.groupBy("word").agg(F.sum("n").alias("n"))


def symbols(k: int) -> str:
    """The symbol of every letter in an alphabet of ``k``: one letter a class, chosen by hash."""
    if k >= len(LETTERS):
        return LETTERS
    return "".join(LETTERS[(ord(c) * 2654435761 >> 15 & 0xFFFF) % k] for c in LETTERS)


def _reduced(word: Column, k: Column) -> Column:
    out = word
    for size in LADDER[:-1]:
        out = F.when(k == size, F.translate(word, LETTERS, symbols(size))).otherwise(out)
    return out


def choose_alphabets(vocab: DataFrame) -> dict[int, int]:
    """Alphabet size of every word length (``LONG`` for that and more).  At most LONG x ladder rows reach the driver."""
    options = F.explode(F.array(*[F.struct(F.lit(k).alias("k"), F.translate("word", LETTERS, symbols(k)).alias("r"))
                                  for k in LADDER[:-1]]))
    buckets = (vocab.select(F.least(F.length("word"), F.lit(LONG)).alias("length"), options.alias("o"))
               .groupBy("length", "o.k", "o.r").agg(F.count(F.lit(1)).alias("c")))
    stats = buckets.groupBy("length", "k").agg(F.sum("c").alias("words"), F.max("c").alias("most"),
                                               F.sum(F.col("c").cast("double") * F.col("c")).alias("squares"))
    out: dict[int, int] = {}
    for r in sorted(stats.collect(), key=lambda r: (r.length, r.k)):
        if r.squares <= BUCKET_MEAN * r.words and r.most <= BUCKET_MAX:
            out.setdefault(r.length, r.k)
    return out


def _alphabet(length: Column, chosen: dict[int, int]) -> Column:
    if not chosen:
        return F.lit(LADDER[-1])
    sizes = F.create_map(*[F.lit(x) for pair in chosen.items() for x in pair])
    return F.coalesce(F.try_element_at(sizes, F.least(length, F.lit(LONG))), F.lit(LADDER[-1]))


def _values(words: list[str]) -> np.ndarray:
    """A random 64-bit value for every letter of words of one length."""
    code = np.frombuffer("".join(words).encode("utf-32-le"), dtype=np.uint32).reshape(len(words), -1)
    return _value(code)


def _value(code: np.ndarray) -> np.ndarray:
    v = (code.astype(np.uint64) + np.uint64(1)) * _MIX
    return (v ^ (v >> np.uint64(29))) * _BASE


def _key(h: np.ndarray, length: int, k: int) -> np.ndarray:
    """Hash of a reduced word of this length in the alphabet of ``k`` symbols."""
    x = (h ^ np.uint64(length * 1_000_003 + k)) * _MIX
    return ((x ^ (x >> np.uint64(31))) * _BASE).view(np.int64)


def _prefixes(v: np.ndarray) -> np.ndarray:
    """Rolling hashes of the first 0, 1, .. letters of each row."""
    out = np.zeros((v.shape[0], v.shape[1] + 1), dtype=np.uint64)
    for i in range(v.shape[1]):
        out[:, i + 1] = out[:, i] * _BASE + v[:, i]
    return out


def word_keys(words: list[str], k: int) -> np.ndarray:
    """Key of each word (all of one length, already reduced)."""
    return _key(_prefixes(_values(words))[:, -1], len(words[0]), k)


def neighbour_keys(words: list[str], k: int, deletions: bool) -> np.ndarray:
    """Keys of the one-edit neighbours of words of one length, a row for each word:
    its deletions, or itself with its replacements and insertions."""
    length, rows = len(words[0]), len(words)
    v = _values(words)
    before = _prefixes(v)
    powers = np.full(length + 2, _BASE)
    powers[0] = 1
    powers = np.multiply.accumulate(powers)
    after = np.zeros((rows, length + 1), dtype=np.uint64)  # of the letters from position i on
    for i in range(length - 1, -1, -1):
        after[:, i] = after[:, i + 1] + v[:, i] * powers[length - 1 - i]
    left = powers[length - 1 - np.arange(length)]
    if deletions:
        return _key(before[:, :-1] * left + after[:, 1:], length - 1, k)
    letter = _value(np.array(sorted({ord(c) for c in symbols(k)}), dtype=np.uint32))
    grown = before[:, :, None] * _BASE + letter  # a prefix and one more letter
    replaced = grown[:, :-1] * left[None, :, None] + after[:, 1:, None]
    inserted = grown * powers[length - np.arange(length + 1)][None, :, None] + after[:, :, None]
    return np.concatenate([_key(before[:, -1:], length, k), _key(replaced.reshape(rows, -1), length, k),
                           _key(inserted.reshape(rows, -1), length + 1, k)], axis=1)


def _by_length(words, sizes):
    """Positions of the words of each (length, alphabet)."""
    groups: dict = {}
    for i, (w, k) in enumerate(zip(words, sizes, strict=True)):
        groups.setdefault((len(w), k), []).append(i)
    return groups.items()


def target_keys(vocab: DataFrame) -> DataFrame:
    """(key, word, n): where the neighbours of other words find each word, in the
    alphabet of its own length and in that of the length below."""

    def make():
        def per_batch(word, n, r, k, r_below, k_below):
            own, below = np.zeros(len(word), dtype=np.int64), np.zeros(len(word), dtype=np.int64)
            for out, reduced, sizes in ((own, r, k), (below, r_below, k_below)):
                for (_, size), at in _by_length(reduced, sizes):
                    out[at] = word_keys([reduced[i] for i in at], size)
            rows = []
            for w, c, x, y in zip(word, n, own.tolist(), below.tolist(), strict=True):
                rows.append((x, w, c))
                if y != x:
                    rows.append((y, w, c))
            return rows

        return per_batch, list

    return flat_arrow(vocab.select("word", "n", "r", "k", "r_below", "k_below"), make,
                      StructType([StructField("key", LongType()), StructField("b", StringType()),
                                  StructField("n_b", LongType())]))


def key_filter(keys: DataFrame, bits: int = FILTER_BITS) -> np.ndarray:
    """Bitmap of 2^bits bits with a bit for every key (2^(bits - 6) longs reach the driver at most)."""
    at = F.col("key").bitwiseAND(F.lit((1 << bits) - 1))
    word, bit = F.shiftright(at, 6), at.bitwiseAND(F.lit(63))
    found = (keys.select(word.alias("w"), F.expr("shiftleft(1L, cast(key & 63L as int))").alias("m"))
             .groupBy("w").agg(F.bit_or("m").alias("m"))).toArrow()
    out = np.zeros(1 << (bits - 6), dtype=np.int64)
    out[found.column("w").to_numpy()] = found.column("m").to_numpy()
    return out


def neighbourhoods(reduced: DataFrame, bitmap: np.ndarray) -> DataFrame:
    """(src, key): the one-edit neighbours of every reduced word (src, r, k, deletions) that the bitmap lets pass."""
    shared = reduced.sparkSession.sparkContext.broadcast(bitmap)

    def make():
        bitmap = shared.value
        low = np.int64(bitmap.shape[0] * 64 - 1)

        def passing(keys):
            at = keys & low
            return (bitmap[at >> 6] >> (at & 63)) & 1 == 1

        def per_batch(src, r, k, deletions):
            out_src, out_key = [], []
            src = np.array(src, dtype=np.int64)
            for drop in (False, True):
                mine = [i for i, d in enumerate(deletions) if d == drop]
                for (length, size), at in _by_length([r[i] for i in mine], [k[i] for i in mine]):
                    step = max(1, CHUNK // ((length + 1) * (1 if drop else 2 * size)))
                    for lo in range(0, len(at), step):
                        part = [mine[i] for i in at[lo:lo + step]]
                        keys = np.sort(neighbour_keys([r[i] for i in part], size, drop), axis=1)
                        fresh = np.ones(keys.shape, dtype=bool)
                        fresh[:, 1:] = keys[:, 1:] != keys[:, :-1]  # each neighbour once
                        row, col = np.nonzero(fresh & passing(keys))
                        out_src.append(src[part][row])
                        out_key.append(keys[row, col])
            if not out_src:
                return []
            return list(zip(np.concatenate(out_src).tolist(), np.concatenate(out_key).tolist(), strict=True))

        return per_batch, list

    return flat_arrow(reduced, make, StructType([StructField("src", LongType()), StructField("key", LongType())]))


def near_words(vocab: DataFrame) -> DataFrame:
    """(a, b, n_b): every ordered pair of near words of ``vocab`` (word, n)."""
    chosen = choose_alphabets(vocab)
    length = F.length("word")
    coded = vocab.select("word", "n", _alphabet(length, chosen).alias("k"), _alphabet(length - 1, chosen).alias("k_below"))
    coded = stage(coded.select("*", _reduced(F.col("word"), F.col("k")).alias("r"),
                               _reduced(F.col("word"), F.col("k_below")).alias("r_below")), "reduced-words")
    targets = stage(target_keys(coded), "reduced-keys")
    ways = F.explode(F.array(F.struct("r", "k", F.lit(False).alias("deletions")),
                             F.struct(F.col("r_below").alias("r"), F.col("k_below").alias("k"),
                                      F.lit(True).alias("deletions"))))
    sources = coded.select("word", ways.alias("w")).select("word", "w.*").withColumn("src", F.xxhash64("r", "k", "deletions"))
    generated = neighbourhoods(sources.select("src", "r", "k", "deletions").distinct(), key_filter(targets))
    pairs = (generated.join(targets, "key").select("src", "b", "n_b")
             .join(sources.select("src", F.col("word").alias("a")), "src"))
    return pairs.where(F.levenshtein("a", "b", 1) == 1).select("a", "b", "n_b")


def last_forms(links: DataFrame) -> DataFrame:
    """(word, root): forms of ``links`` (word, form) followed to the last, doubling the reach in each round."""
    now = stage(links.select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        old, now = now, stage(now.join(ahead, "root", "left")
                              .select("word", F.coalesce("next", "root").alias("root"),
                                      F.col("next").isNotNull().alias("moved")), "roots")
        moved = now.where("moved").limit(1).count()
        discard(old)
        if not moved:
            return now.select("word", "root")


def spelling_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = MIN_LENGTH,
                    min_count: int = MIN_COUNT) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word of at least ``min_length``
    code points that occurs at least ``min_count`` times."""
    counts = word_counts(docs, id_col, text_col)
    vocab = stage(counts.where((F.length("word") >= min_length) & (F.col("n") >= min_count)), "vocabulary")
    best = F.min(F.struct((-F.col("n_b")).alias("neg"), F.col("b")))  # most frequent, then smallest
    near = near_words(vocab).groupBy("a").agg(F.count(F.lit(1)).alias("n_near"), best.alias("top"))
    joined = vocab.join(near.withColumnRenamed("a", "word"), "word", "left")
    has_form = -F.col("top.neg") >= 2 * F.col("n")
    words = stage(joined.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                                F.when(has_form, F.col("top.b")).alias("form"),
                                F.when(has_form, -F.col("top.neg")).alias("form_n")), "words")
    roots = last_forms(words.where(F.col("form").isNotNull()).select("word", "form"))
    return (words.join(roots, "word", "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"))


def brute_force(docs, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT) -> list[tuple]:
    """Plain reference for the tests over (doc_id, text): every pair of words compared."""
    n: Counter = Counter()
    for i, text in docs:
        for run in RUN.findall(lower_ascii(text or "")):
            n[seen_word(i, run)] += 1
    words = [w for w, c in n.items() if c >= min_count and len(w) >= min_length]

    def near(a, b):
        if len(a) > len(b):
            a, b = b, a
        if len(b) - len(a) > 1 or a == b:
            return False
        i = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))  # noqa: B905
        return a[i + (len(a) == len(b)):] == b[i + 1:]

    form, count = {}, {}
    for a in words:
        found = sorted((-n[b], b) for b in words if near(a, b))
        count[a] = len(found)
        if found and -found[0][0] >= 2 * n[a]:
            form[a] = found[0][1]
    out = []
    for a in words:
        root = a
        while root in form:
            root = form[root]
        out.append((a, form.get(a), root, n[a], count[a], n[form[a]] if a in form else None))
    return out
