"""Quality rules with risk-controlled thresholds (operator 10, DataFrame functions only).

Statistics of each text come from built-in array and string functions.  Each
rule compares one statistic with a cutoff; cutoffs are learned on the labelled
holdout per stratum (language):

* the candidates of a rule are a fixed grid, safest first, so the sets of
  rejected documents are nested and may be tested in sequence without a
  correction inside the rule (fixed-sequence testing);
* a cutoff passes if the exact binomial test rejects "more than alpha / rules
  of the good documents of the stratum are rejected", which is the same as its
  Clopper-Pearson upper bound being below alpha / rules;
* the level is delta / (rules * strata): Bonferroni over everything chosen.

So with probability 1 - delta no stratum loses more than ``alpha`` of its good
documents to the learned rules.  Any passing cutoff keeps that guarantee; the one
used rejects the most bad documents, each rejected good one counting against
``PENALTY`` of them (the safest of equals); a rule without a gain is off there.

Statistics are staged once; the holdout is an equi-join on the document id; the
counts are partial aggregates.  Labels cover all their rows, nothing is sampled.

Defined results: a null or word-less text has zero statistics and fails the
base rule (fewer than 20 words); a null stratum is its own stratum; repeated
label rows count once; with no labels every learned rule is off.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.stage import stage
from .common import broadcastable, shielded

ALPHA = 0.05
DELTA = 0.05
PENALTY = 10
WINDOW = 8
_SPACE = r"[ \t-\x0D]+"

# Rule name -> candidate cutoffs from the safest to the boldest; a document is
# rejected when its statistic is above the cutoff.
RULES = {
    "repeat_ratio": (0.28, 0.25, 0.22, 0.19, 0.16, 0.13, 0.10, 0.08, 0.06, 0.04),
    "dup_line_ratio": (0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3, 0.2, 0.1),
    "symbol_ratio": (0.5, 0.4, 0.3, 0.2, 0.15, 0.1, 0.07, 0.05, 0.03, 0.02, 0.01),
    "upper_ratio": (0.95, 0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3, 0.25, 0.2),
    "mark_ratio": (0.5, 0.4, 0.3, 0.25, 0.2, 0.15, 0.1, 0.07, 0.05),
    "same_word_ratio": (0.95, 0.9, 0.8, 0.7, 0.6, 0.5, 0.45, 0.4, 0.35, 0.3, 0.25),
}


def let(value: Column, body) -> Column:
    """``body`` of a value that is computed once (a one-element transform)."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _repeat_words(hashes: Column) -> Column:
    """Words covered by windows of ``WINDOW`` words that occur twice or more.

    Windows are sorted by hash with their position, so equal ones are
    neighbours; a text without an equal pair is answered from the distinct
    count alone."""
    none = F.lit(0).cast("long")

    def covered(windows: Column) -> Column:
        ordered = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        at = let(ordered, lambda s: F.sort_array(F.transform(
            F.filter(s, lambda x, i: F.coalesce(F.get(s, i - 1)["h"] == x["h"], F.lit(False))
                     | F.coalesce(F.get(s, i + 1)["h"] == x["h"], F.lit(False))),
            lambda x: x["i"].cast("long"))))
        start = F.struct(F.lit(-1).cast("long").alias("end"), none.alias("n"))
        return F.aggregate(
            at, start,
            lambda a, p: F.struct((p + WINDOW).alias("end"), (a["n"] + p + WINDOW - F.greatest(a["end"], p)).alias("n")),
            lambda a: a["n"])

    windows = F.transform(
        F.slice(hashes, 1, F.size(hashes) - WINDOW + 1),
        lambda h, i: F.xxhash64(h, *[F.get(hashes, i + k) for k in range(1, WINDOW)]))
    return F.when(F.size(hashes) < WINDOW + 1, none).otherwise(
        let(windows, lambda w: F.when(F.size(F.array_distinct(w)) == F.size(w), none).otherwise(covered(w))))


STATISTICS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_marks",
              "n_same")


def statistics(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with the columns ``__<name>`` of ``STATISTICS``."""
    kept = [F.col(f"`{c}`") for c in docs.columns]
    text = F.coalesce(F.col(text_col), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^ \t-\x0D]"))
    d = docs.select(*kept, F.array_remove(F.split(text, _SPACE), "").alias("__words"), lines.alias("__lines"))
    d = d.select("*", F.transform("__words", lambda w: F.xxhash64(w)).alias("__hashes"))
    long = [
        F.size("__words").alias("__n_words"), F.length(F.array_join("__words", "")).alias("__word_chars"),
        F.regexp_count(text, F.lit(r"[#*$%&|<>]")).alias("__n_symbols"),
        (F.size("__lines") - F.size(F.array_distinct("__lines"))).alias("__n_dup_lines"),
        _repeat_words(F.col("__hashes")).alias("__n_repeat_words"), F.size("__lines").alias("__n_lines"),
        F.regexp_count(text, F.lit(r"[A-Z]")).alias("__n_upper"),
        F.regexp_count(text, F.lit(r"[!?{}\[\]=_~^@\\/]")).alias("__n_marks"),
        # words equal to the word before them
        F.size(F.filter("__hashes", lambda h, i: F.coalesce(F.get(F.col("__hashes"), i - 1) == h, F.lit(False))))
        .alias("__n_same"),
    ]
    return d.select(*kept, *[c.cast("long").alias(f"__{n}") for c, n in zip(long, STATISTICS, strict=True)])


def ratio(rule: str) -> Column:
    words, chars = F.nullif(F.col("__n_words"), F.lit(0)), F.nullif(F.col("__word_chars"), F.lit(0))
    value = {"repeat_ratio": F.col("__n_repeat_words") / words,
             "dup_line_ratio": F.col("__n_dup_lines") / F.nullif(F.col("__n_lines"), F.lit(0)),
             "symbol_ratio": F.col("__n_symbols") / chars, "upper_ratio": F.col("__n_upper") / chars,
             "mark_ratio": F.col("__n_marks") / chars, "same_word_ratio": F.col("__n_same") / words}[rule]
    return F.coalesce(value, F.lit(0.0))


def base_failed() -> Column:
    return (F.col("__n_words") < 20) | (100 * F.col("__n_repeat_words") > 30 * F.col("__n_words"))


def binomial_log_cdf(k: Column, n: Column, p: float) -> Column:
    """log P(X <= k) for X ~ Binomial(n, p), summed term by term in log space."""
    odds = math.log(p) - math.log1p(-p)
    first = n * F.lit(math.log1p(-p))
    zero = F.struct(first.alias("t"), first.alias("s"))

    def step(a: Column, i: Column) -> Column:
        t = a["t"] + F.log((n - i + 1) / i) + F.lit(odds)
        return F.struct(t.alias("t"), (F.greatest(a["s"], t) + F.log1p(F.exp(-F.abs(a["s"] - t)))).alias("s"))

    return F.when(k <= 0, first).otherwise(F.aggregate(F.sequence(F.lit(1).cast("long"), F.greatest(k, F.lit(1))),
                                                       zero, step, lambda a: a["s"]))


def learn_cutoffs(stats: DataFrame, labels: DataFrame, id_col: str = "doc_id", stratum_col: str = "lang",
                  alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """(__stratum, __cut_<rule>): the certified cutoff of each rule, null where it
    is off; strata without any are left out."""
    marks = labels.select(F.col(id_col).alias("__id"), F.col("quality").alias("__good")).where(
        F.col("__good").isin(0, 1)).distinct()
    held = stats.select(F.col(id_col).alias("__id"), F.coalesce(F.col(stratum_col), F.lit("")).alias("__stratum"),
                        *[ratio(r).alias(f"__{r}") for r in RULES]).join(marks, "__id")
    good = F.col("__good") == 1
    counts = []
    for rule, grid in RULES.items():
        for j, cut in enumerate(grid):
            over = F.col(f"__{rule}") > cut
            counts += [F.count_if(good & over).alias(f"{rule}_k{j}"), F.count_if(~good & over).alias(f"{rule}_b{j}")]
    # one row per stratum, then one per stratum and cutoff
    table = stage(held.groupBy("__stratum").agg(F.count_if(good).alias("n"), *counts), "holdout-counts")
    strata = max(1, table.count())
    share, level = alpha / len(RULES), math.log(delta / len(RULES) / strata)
    tried = F.array(*[F.struct(F.lit(rule).alias("rule"), F.lit(j).alias("j"), F.lit(cut).alias("cut"),
                               F.col(f"{rule}_k{j}").alias("k"), F.col(f"{rule}_b{j}").alias("bad"))
                      for rule, grid in RULES.items() for j, cut in enumerate(grid)])
    tests = table.select("__stratum", "n", F.explode(tried).alias("t")).select("__stratum", "n", "t.*")
    # k grows along a grid and the tail grows with k, so a cutoff that passes has
    # only passing ones before it; a share at or above the limit cannot pass
    gain = F.col("bad") - PENALTY * F.col("k")
    passed = tests.where((F.col("k") < F.col("n") * share) & (gain > 0)).where(
        binomial_log_cdf(F.col("k"), F.col("n"), share) <= level)
    merit = F.struct(gain.alias("gain"), (-F.col("j")).alias("safe"))
    best = passed.groupBy("__stratum").agg(*[
        F.max_by(F.when(F.col("rule") == r, F.col("cut")), F.when(F.col("rule") == r, merit)).alias(f"__cut_{r}")
        for r in RULES])
    return best


def judge(stats: DataFrame, cutoffs: DataFrame, stratum_col: str = "lang") -> DataFrame:
    """``stats`` with ``__base_failed`` and ``__kept``."""
    names = stats.columns
    d = stats.withColumn("__stratum", F.coalesce(F.col(stratum_col), F.lit("")))
    # one row per labelled stratum; counted before it is broadcast
    d = d.join(broadcastable(cutoffs), "__stratum", "left")
    rejected = F.lit(False)
    for rule in RULES:
        rejected = rejected | F.coalesce(ratio(rule) > F.col(f"__cut_{rule}"), F.lit(False))
    return d.select(*[F.col(f"`{c}`") for c in names], base_failed().alias("__base_failed"),
                    (~base_failed() & ~rejected).alias("__kept"))


def quality_report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The digest of the contract: one row per document."""
    stats = stage(statistics(docs.select("doc_id", "lang", "text")).drop("text"), "quality")
    cutoffs = stage(learn_cutoffs(stats, labels), "cutoffs")
    out = judge(stats, cutoffs)
    return out.select("doc_id", *[F.col(f"__{n}").alias(n) for n in STATISTICS[:5]],
                      F.col("__base_failed").alias("base_failed"), F.col("__kept").alias("kept"))


@shielded
def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` without the documents that the rules reject; all columns kept."""
    stats = stage(statistics(docs), "quality-docs")  # staged: the filter would repeat the expressions
    cutoffs = stage(learn_cutoffs(stats, labels), "cutoffs")
    return judge(stats, cutoffs).where("__kept").select(*[F.col(f"`{c}`") for c in docs.columns])
