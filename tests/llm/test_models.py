"""Language identification and toxicity: gradients, automata, held-out accuracy, edge cases."""

import random

import numpy as np
from pyspark.sql import functions as F

from martspark.llm import langid, toxicity

from .conftest import EDGE

SYLLABLES = {"en": "the ing tion of and er wh".split(), "de": "sch ung ein ver äu heit ü".split(),
             "fr": "eau oi é queue ment è ai".split()}


def text_in(rng, lang, n=60):
    return " ".join("".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randint(1, 3))) for _ in range(n))


def test_gru_gradients_and_fast_scorer():
    rng = np.random.default_rng(0)
    x = rng.integers(1, 255, (6, 10)).astype(np.uint8)
    x[0, 7:] = 0
    y = np.array([0, 1, 2, 0, 1, 2])
    p32 = langid.init(3)
    p = {k: v.astype(np.float64) for k, v in p32.items()}
    loss, grad = langid.gradients(x, y, p)
    lp = langid.log_probs(x, p32)
    mask = x.T != 0
    assert abs(-(lp[:, np.arange(6), y] * mask).sum() / mask.sum() - loss) < 1e-5
    for k in p:
        for _ in range(4):
            i = tuple(int(rng.integers(0, d)) for d in p[k].shape)
            i = (int(x[0, 3]), i[1]) if k[0] == "x" else i
            side = []
            for e in (1e-3, -1e-3):
                q = {a: b.copy() for a, b in p.items()}
                q[k][i] += e
                side.append(langid.gradients(x, y, q)[0])
            assert abs((side[0] - side[1]) / 2e-3 - grad[k][i]) < 1e-5


def test_segments_cover_the_whole_text():
    data = bytes(range(1, 200))
    assert langid.segments_of(data).reshape(-1)[:199].tobytes() == data


def test_language_held_out_accuracy_and_edges(spark, docs_of):
    rng = random.Random(1)
    rows = [(i, text_in(rng, lang), lang, "s") for i, lang in enumerate(list(SYLLABLES) * 60)]
    out = langid.language_report(docs_of(rows + EDGE)).collect()
    assert len(out) == len(rows) + len(EDGE)
    truth = {i: g for i, _, g, _ in rows}
    held = [r for r in out if r["held_out"] and r["doc_id"] in truth and r["doc_id"] > 8]
    assert len(held) > 20 and np.mean([r["lang_pred"] == truth[r["doc_id"]] for r in held]) > 0.95
    blank = {r["doc_id"]: r for r in out}
    assert all(0 <= r["score"] <= 1 for r in out)
    empty = langid.language_report(docs_of([(1, None, "en", "s"), (2, "", "en", "s"), (3, "12 !", "en", "s"),
                                            (4, "abc", None, "s")])).collect()
    assert {r["lang_pred"] for r in empty} == {"und"} and blank[7]["lang_pred"] in truth.values()
    assert langid.language_report(docs_of([])).count() == 0


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(new[-1] + 1, row[j] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def test_trie_finds_exactly_the_terms_within_reach():
    rng = random.Random(2)
    terms = {b"idiot": 1.0, b"loser": 2.0, b"pathetic": 3.0, b"disgusting": 4.0, b"bad": 5.0, "schläger".encode(): 6.0}
    trie = toxicity.LexiconTrie(terms, {b"vequ": 7.0})
    words = [b"vequist", b"veq", b""]
    for t in list(terms) * 60:
        w = list(t)
        for _ in range(rng.randint(0, 3)):
            k = rng.randrange(3)
            i = rng.randrange(len(w) + (k == 0))
            if k == 0:
                w.insert(i, rng.choice(t))
            elif k == 1:
                w[i] = rng.choice(b"abcxyz0")
            elif len(w) > 1:
                del w[i]
        words.append(bytes(w))
    for w in words:
        near = [(-d, x) for t, x in terms.items() if (d := distance(w, t)) <= toxicity.allowed_edits(len(t))]
        want = (7.0, 0) if w.startswith(b"vequ") else (max(near)[1], -max(near)[0]) if near else None
        assert trie.find(w) == want, w


def test_quotation_counts_apart_from_abuse():
    trie = toxicity.LexiconTrie({b"idiot": 4.0}, {})
    abuse = toxicity.text_features("you are an idi0t, really", trie, {})
    quoted = toxicity.text_features("a sign “no idiot here” was seen", trie, {})
    reported = toxicity.text_features("he said idiot to us", trie, {})
    assert abuse[0] > 0 and abuse[2] == 0 and abuse[4] > 0
    assert quoted[0] == 0 and quoted[2] > 0 and reported[0] == 0 and reported[2] > 0


def toxic_corpus(n=400):
    rng = random.Random(4)
    rows, labels = [], []
    for i in range(n):
        toxic = i % 4 == 0
        words = text_in(rng, "en", 40).split()
        if toxic:
            for _ in range(3):
                words.insert(rng.randrange(len(words)), rng.choice(["idiot", "moron", "vequ" + rng.choice("abcdef")]))
        if toxic and i % 5 == 0:
            words = [w.replace("i", "1", 1) if w == "idiot" else w for w in words]
        rows.append((i, " ".join(words), "en", "s"))
        labels.append((i, 1, int(toxic)))
    return rows, labels


def test_toxicity_held_out_and_edges(spark, docs_of):
    rows, labels = toxic_corpus()
    marks = spark.createDataFrame(labels + [(5, None, None), (None, 1, 1), (7, 1, 0), (7, 1, 0)],
                                  "doc_id long, quality int, toxic int")
    out = toxicity.toxicity_report(docs_of(rows + EDGE), marks).collect()
    assert len(out) == len(rows) + len(EDGE)
    held = [r for r in out if r["held_out"] and r["doc_id"] >= 9]
    assert len(held) > 40
    assert all(r["predicted"] == int(r["doc_id"] % 4 == 0) for r in held)
    blank = [r["score"] for r in out if r["doc_id"] in (2, 3)]
    assert all(0 <= s < 0.5 for s in blank)


def test_toxicity_without_usable_labels(spark, docs_of):
    marks = spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int")
    for m in (marks, marks.where(F.lit(False))):
        out = toxicity.toxicity_report(docs_of(EDGE), m).collect()
        assert len(out) == len(EDGE) and {r["score"] for r in out} == {0.0}
    assert toxicity.toxicity_report(docs_of([]), marks).count() == 0
