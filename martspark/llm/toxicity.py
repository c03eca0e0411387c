"""Toxicity by Levenshtein automata over a lexicon trie (operator 7).

The lexicon (whole words, and stems that stand for all words they begin) is
learned from labelled rows: terms that occur far more often in toxic than in
clean texts.  It is a trie; the Levenshtein automaton of a word is run down the
trie, so one walk finds every term within the allowed distance (misspellings).
Each hit is scored in a window of words around it: a hit inside quotation marks
or next to a reporting word counts as quotation, any other as abuse.  A logistic
model over the two sums, their densities and the misspelled hits gives the score.

Learning uses at most ``FIT_ROWS`` labelled rows, the first ones by hash of the
id (a documented, bounded sample); scoring reads every whole text once, in Arrow
batches, without a shuffle.

Defined results: a null or empty text has no hit and gets the score of a text
without hits; null labels are not learned from; without usable labels of both
kinds every score is 0; repeated rows are scored each; tables may be empty.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (ArrayType, BooleanType, DoubleType, IntegerType, LongType, StringType, StructField,
                               StructType)

from ..plans.stage import stage
from .common import alnum_words, flat_arrow, lowered, with_arrow
from .jaccard import shingles

FIT_ROWS = 8000
MAX_TERMS = 500
MIN_TOXIC = 6       # toxic sample texts that hold a term, and
MIN_SHARE = 0.01    # their share of the toxic sample texts
MIN_WEIGHT = 3.0    # log ratio of its frequency in toxic and in clean texts
STEMS = (4, 5, 6)   # lengths of the stems tried
WINDOW = 8          # words on either side of a hit
_CACHE = 500_000

# Words that report speech rather than abuse.
REPORTING = frozenset(b"said says saying wrote writes quote quoted quoting called word words term terms slur "
                      b"insult insults means meaning defined definition".split())
_PARAGRAPH_END = re.compile(r"\n[ \t\r]*\n")
_QUOTES = {'"': '"', "“": "”", "«": "»", "„": "“", "‘": "’"}


def allowed_edits(length: int) -> int:
    return 0 if length < 5 else 1 if length < 9 else 2


class LexiconTrie:
    """Terms as a trie of bytes; ``find`` intersects it with the Levenshtein automaton of a word."""

    def __init__(self, words: dict[bytes, float], stems: dict[bytes, float]):
        self.words, self.stems = words, stems
        self.root: dict = {}
        for term in words:
            node = self.root
            for b in term:
                node = node.setdefault(b, {})
            node[None] = term
        self.longest = max(map(len, words), default=0) + 2
        # pigeonhole: of edits + 1 pieces of a term one stands unchanged in the word
        pieces = set()
        for term in words:
            k = allowed_edits(len(term)) + 1
            cuts = [len(term) * i // k for i in range(k + 1)]
            pieces |= {term[a:b] for a, b in zip(cuts, cuts[1:], strict=False)}
        self.pieces = re.compile(b"|".join(sorted(re.escape(p) for p in pieces))) if pieces else None
        self.stem_sizes = sorted({len(s) for s in stems})

    def find(self, word: bytes) -> tuple[float, int] | None:
        """(weight, edits) of the best term: fewest edits, then the largest weight."""
        if word in self.words:
            return self.words[word], 0
        for n in self.stem_sizes:
            if word[:n] in self.stems:
                return self.stems[word[:n]], 0
        if self.pieces is None or len(word) > self.longest or not self.pieces.search(word):
            return None
        best = None
        stack = [(self.root, tuple(range(len(word) + 1)))]  # state: distances to the word's prefixes
        while stack:
            node, row = stack.pop()
            for b, child in node.items():
                if b is None:
                    edits = row[-1]
                    if edits <= allowed_edits(len(child)):
                        key = (-edits, self.words[child])
                        best = key if best is None else max(best, key)
                    continue
                new = [row[0] + 1]
                for i, c in enumerate(word):
                    new.append(min(new[i] + 1, row[i + 1] + 1, row[i] + (b != c)))
                if min(new) <= 2:
                    stack.append((child, tuple(new)))
        return (best[1], -best[0]) if best else None


def _quoted_ranges(text: str) -> list[tuple[int, int]]:
    """Spans between a quotation mark and its partner in the same paragraph, however long."""
    out = []
    ends = [m.start() for m in _PARAGRAPH_END.finditer(text)] + [len(text)]
    paragraph = behind = 0
    missing: set[str] = set()  # partners that this paragraph has no more of
    for m in re.finditer(r"[\"“«„‘]", text):
        if m.start() < behind:
            continue
        while ends[paragraph] < m.start():
            paragraph += 1
            missing.clear()
        partner = _QUOTES[m.group()]
        end = -1 if partner in missing else text.find(partner, m.end(), ends[paragraph])
        if end < 0:
            missing.add(partner)
        else:
            behind = end + 1
            out.append((m.start(), behind))
    return out


_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")


def text_features(text: str | None, trie: LexiconTrie, cache: dict) -> list[float]:
    """[abuse, abuse per word, quoted, quoted per word, misspelled hits, any hit]"""
    words = alnum_words(text)
    hits = {}
    for w in set(words):
        found = cache.get(w, 0)
        if found == 0:
            if len(cache) > _CACHE:
                cache.clear()
            found = cache[w] = trie.find(w)
        if found is not None:
            hits[w] = found
    if not hits:
        return [0.0] * 6
    data = lowered(text)
    quoted_spans = [(len(text[:a].encode("utf-8", "surrogatepass")), len(text[:b].encode("utf-8", "surrogatepass")))
                    for a, b in _quoted_ranges(text)]
    reporting = {i for i, w in enumerate(words) if w in REPORTING}
    abuse = quoted = wrong = 0.0
    span = 0
    for i, m in enumerate(_WORD.finditer(data)):
        hit = hits.get(m.group())
        if hit is None:
            continue
        while span < len(quoted_spans) and quoted_spans[span][1] <= m.start():
            span += 1
        inside = span < len(quoted_spans) and quoted_spans[span][0] < m.start()
        near = reporting and any(j in reporting for j in range(max(0, i - WINDOW), i + WINDOW + 1))
        weight = hit[0] / (1 + hit[1])
        if inside or near:
            quoted += weight
        else:
            abuse += weight
        wrong += hit[1] > 0
    n = len(words)
    return [math.log1p(abuse), 10 * abuse / n, math.log1p(quoted), 10 * quoted / n, math.log1p(wrong),
            float(abuse > 0)]


def fit_sample(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", limit: int = FIT_ROWS) -> DataFrame:
    """(text, toxic) of the sample: the first ``limit`` labelled rows by hash of the id."""
    ids = (labels.where(F.col("toxic").isin(0, 1)).select(F.col(id_col).alias("__id"), F.col("toxic").alias("__toxic"))
           .where(F.crc32(F.col("__id").cast("string").cast("binary")) % 5 != 0)
           .groupBy("__id").agg(F.max("__toxic").alias("__toxic"))
           .orderBy(F.xxhash64("__id"), "__id").limit(limit))
    held = (docs.join(F.broadcast(ids), docs[id_col] == F.col("__id"))  # at most ``limit`` rows
            .select(F.col("text"), F.col("__toxic").alias("toxic")))

    def make():
        def one(text):
            s = shingles(text)
            return (int(s[:1].view(np.int64)[0]) if len(s) else None,)

        return one

    # copies and most near copies share their smallest shingle: they count once
    keyed = with_arrow(held, ["text"], make, [StructField("__key", LongType())])
    return keyed.groupBy("__key", "toxic").agg(F.min("text").alias("text")).select("text", "toxic")


def learn_lexicon(sample: DataFrame) -> LexiconTrie:
    """Terms of the (bounded, staged) sample; at most MAX_TERMS reach the driver."""

    def make():
        counts: Counter = Counter()

        def per_batch(texts, toxic):
            for text, mark in zip(texts, toxic, strict=True):
                words = set(alnum_words(text))
                terms = {(w, False) for w in words}
                for n in STEMS:
                    terms |= {(w[:n], True) for w in words if len(w) > n}
                counts.update((t, stem, mark) for t, stem in terms)
                counts[(b"", False, mark)] += 1
            return []

        def at_end():
            return [(t.decode("utf-8", "surrogateescape").encode("utf-8", "replace").decode("utf-8"), s, int(m), n)
                    for (t, s, m), n in counts.items() if _whole(t)]

        return per_batch, at_end

    schema = StructType([StructField("term", StringType()), StructField("stem", BooleanType()),
                         StructField("toxic", IntegerType()), StructField("n", LongType())])
    counts = (flat_arrow(sample.select("text", "toxic"), make, schema).groupBy("term", "stem")
              .agg(F.sum(F.when(F.col("toxic") == 1, F.col("n")).otherwise(0)).alias("t"),
                   F.sum(F.when(F.col("toxic") == 0, F.col("n")).otherwise(0)).alias("c")))
    counts = stage(counts, "term-counts")
    size = counts.where((F.col("term") == "") & ~F.col("stem")).first()
    if size is None or not size["t"] or not size["c"]:
        return LexiconTrie({}, {})
    weight = (F.log((F.col("t") + 0.5) / (size["t"] + 1)) - F.log((F.col("c") + 0.5) / (size["c"] + 1)))
    found = (counts.where((F.col("term") != "") & (F.col("t") >= max(MIN_TOXIC, MIN_SHARE * size["t"]))).withColumn("w", weight)
             .where(F.col("w") >= MIN_WEIGHT).orderBy(F.desc("w"), "term", "stem").limit(MAX_TERMS).collect())
    words = {r["term"].encode(): r for r in found if not r["stem"]}
    stems: dict[bytes, float] = {}
    for r in sorted((r for r in found if r["stem"]), key=lambda r: (len(r["term"].encode()), r["term"])):
        term = r["term"].encode()
        own = [w for w in words if w.startswith(term) and len(w) > len(term)]
        # a stem is worth it if it says more than the one word (or shorter stem) that carries it
        if any(term.startswith(s) for s in stems) or (own and max(words[w]["t"] for w in own) >= 0.8 * r["t"]):
            continue
        stems[term] = r["w"]
    # words that a stem covers stay, so that their misspellings are found within the stem too
    return LexiconTrie({w: r["w"] for w, r in words.items()}, stems)


def _whole(term: bytes) -> bool:
    """Whether a cut term ends between code points."""
    try:
        term.decode("utf-8")
    except UnicodeDecodeError:
        return False
    return True


def fit_logistic(x: np.ndarray, y: np.ndarray, prior: np.ndarray, strength: float = 1.0, steps: int = 40) -> np.ndarray:
    """Damped Newton steps, weights drawn towards ``prior`` (the intercept nearly free)."""
    a = np.hstack([x, np.ones((len(x), 1))])
    w = np.append(prior, 0.0)
    centre, keep = w.copy(), np.append(np.full(len(prior), strength), 1e-3)

    def loss(w):
        z = a @ w
        return np.sum(np.logaddexp(0, z) - y * z) + 0.5 * keep @ (w - centre) ** 2

    now = loss(w)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        grad = a.T @ (p - y) + keep * (w - centre)
        step = np.linalg.solve((a * (p * (1 - p))[:, None]).T @ a + np.diag(keep), grad)
        size = 1.0
        while (new := loss(w - size * step)) > now and size > 1e-6:  # halve until it helps
            size /= 2
        if now - new < 1e-9 * abs(now):
            break
        w, now = w - size * step, new
    return w


# Abuse counts for, quotation weighs little until labels say otherwise.
PRIOR = np.array([1.0, 0.5, 0.2, 0.1, 0.2, 1.0])


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", limit: int = FIT_ROWS):
    """(trie, weights), or None where the labels do not hold both kinds."""
    sample = stage(fit_sample(docs, labels, id_col, limit), "toxic-sample")
    trie = learn_lexicon(sample)

    def make():
        cache: dict = {}
        return lambda text: (text_features(text, trie, cache),)

    rows = with_arrow(sample.select("text", "toxic"), ["text"], make, [StructField("f", ArrayType(DoubleType()))])
    rows = rows.select("f", "toxic").collect()  # at most ``limit`` rows of six numbers
    y = np.array([r["toxic"] for r in rows], dtype=float)
    if not len(y) or y.min() == y.max():
        return None
    return trie, fit_logistic(np.array([r["f"] for r in rows]), y, PRIOR)


def score_texts(docs: DataFrame, model, text_col: str = "text") -> DataFrame:
    """``docs`` with ``__score``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # at most MAX_TERMS terms and 7 numbers

    def make():
        if shared.value is None:
            return lambda text: (0.0,)
        trie, w = shared.value
        cache: dict = {}

        def one(text):
            z = float(np.dot(text_features(text, trie, cache), w[:-1]) + w[-1])
            return (1 / (1 + math.exp(-max(-30.0, min(30.0, z)))),)

        return one

    return with_arrow(docs, [text_col], make, [StructField("__score", DoubleType())])


def toxicity_report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The digest of the contract: one row per document."""
    model = fit(docs.select("doc_id", "text"), labels)
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    out = score_texts(docs.select("doc_id", "text"), model)
    return out.select("doc_id", F.coalesce(held, F.lit(False)).alias("held_out"), F.col("__score").alias("score"),
                      (F.col("__score") >= 0.5).cast("int").alias("predicted"))
