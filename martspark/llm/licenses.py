"""License scans by an exact set-similarity join (operator 9).

Blocks are the lines of a text; templates are the notices of ``TEMPLATES``, a
fixed short list.  A block is labelled with a template when it holds at least
``threshold`` of the template's distinct words.  Words are put in one global
order, rarest first by the number of corpus blocks that hold them (counted over
all documents), and a block is verified against a template only if

* length: it has at least ceil(threshold * |template|) distinct words,
* prefix: it holds one of the template's |template| - required + 1 rarest words,
* position: from the first shared word on, both sides still have enough words.

The template side has a fixed size, so its index travels with the tasks and
documents are never shuffled.  Base phrases are found as runs of words over the
whole text.

A notice wrapped over several lines is a block too: a window of at most
|template words| / threshold words of the text, whatever its line ends, whose
words stand in the template's order (a longest common subsequence with it holds
the distinct words that count).  Order keeps common words of neighbouring lines
from completing a notice.  Windows are looked at only around prefix words, pass
the same length and position bounds, and are verified only where they can raise
the template's containment.

Defined results: a null text is empty; repeated rows are kept; word counts are
over the whole text; a text without a place has null first and last word, empty
labels and score 0; tables may be empty.
"""

from __future__ import annotations

import math
from bisect import bisect_right
from collections import Counter

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, StringType, StructField, StructType

from .common import alnum_words, flat_arrow, with_arrow

THRESHOLD = 0.8

# Base phrases and their labels.
PHRASES = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))

# Short public license notices by SPDX-like label.
TEMPLATES = (
    ("apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("apache-2.0-header", "you may not use this file except in compliance with the License. "
                          "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("mit", "Released under the MIT License"),
    ("mit-grant", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software "
                  "and associated documentation files, to deal in the Software without restriction"),
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3"),
    ("gpl-notice", "This program is free software: you can redistribute it and/or modify it under the terms of the "
                   "GNU General Public License as published by the Free Software Foundation"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted "
            "provided that the following conditions are met"),
    ("cc-by-4.0", "Licensed under CC BY 4.0"),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0"),
    ("cc-by-sa-4.0", "Licensed under CC BY-SA 4.0"),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
)


def template_sets(templates=TEMPLATES) -> dict[str, frozenset[bytes]]:
    return {label: frozenset(alnum_words(text)) for label, text in templates}


def required_overlap(size: int, threshold: float) -> int:
    return max(1, math.ceil(threshold * size - 1e-9))


def vocabulary_counts(docs: DataFrame, text_col: str = "text", templates=TEMPLATES) -> DataFrame:
    """(word, n): blocks of the corpus holding each template word."""
    vocabulary = frozenset().union(*template_sets(templates).values())

    def make():
        counts: Counter = Counter()

        def per_batch(texts):
            for t in texts:
                for line in (t or "").split("\n"):
                    counts.update(vocabulary.intersection(alnum_words(line)))
            return []

        return per_batch, lambda: [(w.decode("utf-8", "replace"), n) for w, n in counts.items()]

    schema = StructType([StructField("word", StringType()), StructField("n", LongType())])
    return flat_arrow(docs.select(text_col), make, schema).groupBy("word").agg(F.sum("n").alias("n"))


class TemplateIndex:
    def __init__(self, counts: dict[bytes, int], templates=TEMPLATES, threshold: float = THRESHOLD):
        self.sets = template_sets(templates)
        self.order = {w: r for r, w in enumerate(sorted(frozenset().union(*self.sets.values()),
                                                        key=lambda w: (counts.get(w, 0), w)))}
        self.need = {label: required_overlap(len(s), threshold) for label, s in self.sets.items()}
        self.words = {label: alnum_words(text) for label, text in templates}
        self.window = {label: math.ceil(len(w) / threshold) for label, w in self.words.items()}
        self.rare: dict[str, frozenset[bytes]] = {}
        self.prefix: dict[bytes, list[tuple[str, int]]] = {}
        for label, s in self.sets.items():
            ranked = sorted(s, key=self.order.__getitem__)
            self.rare[label] = frozenset(ranked[:len(ranked) - self.need[label] + 1])
            for position, w in enumerate(ranked[:len(ranked) - self.need[label] + 1]):
                self.prefix.setdefault(w, []).append((label, position))
        self.keys = frozenset(self.prefix)

    def match(self, words) -> list[tuple[str, float]]:
        """(label, containment) of each template that the block's words hold far enough."""
        block = frozenset(words)
        shared = self.keys & block
        if not shared:
            return []
        known = sorted(block & self.order.keys(), key=self.order.__getitem__)
        at = {w: i for i, w in enumerate(known)}
        out, seen = [], set()
        for w in sorted(shared, key=self.order.__getitem__):
            for label, position in self.prefix[w]:
                if label in seen:
                    continue
                seen.add(label)  # verified once, at the first shared prefix word
                template, need = self.sets[label], self.need[label]
                if len(block) < need or min(len(template) - position, len(known) - at[w]) < need:
                    continue
                overlap = len(template & block)
                if overlap >= need:
                    out.append((label, overlap / len(template)))
        return out


    def wrapped(self, words: list[bytes], found: dict[str, list[tuple[int, int, float]]]) -> list[tuple[int, str, float]]:
        """(first word, label, containment) of every window that holds a template far enough: of windows
        that overlap the best one, and beside a block of the template in ``found`` (label to word ranges with
        their containment) only a better one."""
        shared = self.keys.intersection(words)
        out = []
        for label in sorted({label for w in shared for label, _ in self.prefix[w]}):
            template, rare, width = self.sets[label], self.rare[label], self.window[label]
            best, start, end = 0.0, -1, -1
            taken = found.get(label, [])
            block = 0
            at = [i for i, w in enumerate(words) if w in template]
            counts: Counter = Counter()
            lo = n_rare = 0
            for hi, i in enumerate(at):
                counts[words[i]] += 1
                n_rare += words[i] in rare
                while at[lo] <= i - width:
                    w = words[at[lo]]
                    counts[w] -= 1
                    n_rare -= w in rare
                    if not counts[w]:
                        del counts[w]
                    lo += 1
                if start >= 0 and at[lo] > end:  # the window has left the last one found
                    out.append((start, label, best))
                    best, start = 0.0, -1
                while block < len(taken) and taken[block][1] <= at[lo]:
                    block += 1
                line = taken[block][2] if block < len(taken) and taken[block][0] <= i else 0.0
                if n_rare and len(counts) >= self.need[label] and len(counts) / len(template) > max(best, line):
                    overlap = in_order([words[j] for j in at[lo:hi + 1]], self.words[label])
                    if overlap >= self.need[label] and overlap / len(template) > max(best, line):
                        best, start, end = overlap / len(template), at[lo], i
            if start >= 0:
                out.append((start, label, best))
        return out


def in_order(found: list[bytes], template: list[bytes]) -> int:
    """Distinct words of a longest common subsequence of both."""
    rows = [[0] * (len(template) + 1)]
    for w in found:
        up, row = rows[-1], [0]
        for k, t in enumerate(template):
            row.append(up[k] + 1 if w == t else max(up[k + 1], row[k]))
        rows.append(row)
    held, i, k = set(), len(found), len(template)
    while i and k:
        if found[i - 1] == template[k - 1]:
            held.add(found[i - 1])
            i, k = i - 1, k - 1
        elif rows[i - 1][k] >= rows[i][k - 1]:
            i -= 1
        else:
            k -= 1
    return len(held)


def phrase_places(words: list[bytes], phrases=PHRASES) -> list[tuple[int, str]]:
    """(start word, label) of every place of every phrase, sorted."""
    text = b" " + b" ".join(words) + b" "
    out = []
    for phrase, label in phrases:
        key = b" " + phrase.encode() + b" "
        at, word, counted = text.find(key), 0, 0
        while at >= 0:
            word += text.count(b" ", counted, at)  # each word is counted once
            counted = at
            out.append((word, label))
            at = text.find(key, at + 1)
    return sorted(out)


BLOCK = StructType([StructField("block", LongType()), StructField("label", StringType()),
                    StructField("containment", DoubleType())])
PLACE = StructType([StructField("word", LongType()), StructField("label", StringType())])


def scan_licenses(docs: DataFrame, text_col: str = "text", templates=TEMPLATES,
                  threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with ``__n_words``, ``__places`` (base phrases) and ``__blocks``
    (line number, label, containment of every matching line and of every matching window
    over several lines, at its first line)."""
    # at most one row per template word: a fixed size
    counts = {r["word"].encode(): r["n"] for r in vocabulary_counts(docs, text_col, templates).collect()}
    index = TemplateIndex(counts, templates, threshold)

    def make():
        def one(text):
            blocks, words, ends, found = [], [], [], {}  # found: word ranges of the lines of each label
            for i, line in enumerate((text or "").split("\n")):
                own = alnum_words(line)
                words += own
                ends.append(len(words))
                for label, c in index.match(own):
                    blocks.append({"block": i, "label": label, "containment": c})
                    found.setdefault(label, []).append((len(words) - len(own), len(words), c))
            blocks += [{"block": bisect_right(ends, at), "label": label, "containment": c}
                       for at, label, c in index.wrapped(words, found)]
            places = [{"word": w, "label": label} for w, label in phrase_places(words)]
            return len(words), places, blocks

        return one

    return with_arrow(docs, [text_col], make, [StructField("__n_words", LongType()),
                                               StructField("__places", ArrayType(PLACE)),
                                               StructField("__blocks", ArrayType(BLOCK))])


def license_report(docs: DataFrame) -> DataFrame:
    """The digest of the contract: one row per document."""
    found = scan_licenses(docs.select("doc_id", "text"))
    base = F.array_sort(F.array_distinct(F.transform("__places", lambda p: p["label"])))
    own = F.transform("__blocks", lambda b: b["label"])
    both = F.array_sort(F.array_distinct(F.concat(base, own)))
    best = F.coalesce(F.array_max(F.transform("__blocks", lambda b: b["containment"])), F.lit(0.0))
    return found.select(
        "doc_id", F.col("__n_words").alias("n_words"), F.size("__places").cast("long").alias("n_base"),
        F.array_min(F.transform("__places", lambda p: p["word"])).alias("first_word"),
        F.array_max(F.transform("__places", lambda p: p["word"])).alias("last_word"),
        F.array_join(base, ",").alias("base_labels"), F.array_join(both, ",").alias("labels"),
        F.when(F.size("__places") > 0, F.lit(1.0)).otherwise(best).alias("score"))
