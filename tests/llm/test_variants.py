"""HyperMinHash near duplicates, conversation trie and spelling variants against brute force."""

import random

import numpy as np
from pyspark.sql import functions as F

from martspark.llm import conversations, hyperminhash, jaccard, spelling

from .conftest import EDGE
from .test_scans import collected

CONV = "conv_id long, turn long, role string, text string"


def families(rng, words=3000):
    """Near copies of a few texts, similarities on both sides of the threshold, and short texts."""
    vocab = [f"w{i}" for i in range(words)]
    out = []
    for f, size in enumerate((12, 40, 200)):
        base = [rng.choice(vocab) for _ in range(size)]
        for i in range(14):
            copy = list(base)
            for _ in range(rng.choice([0, 1, 1, 2, 3]) * max(1, size // 100)):
                copy[rng.randrange(size)] = rng.choice(vocab)
            out.append((1000 * f + i, " ".join(copy)))
    out += [(9000 + i, " ".join(rng.choice(vocab) for _ in range(rng.randint(0, 8)))) for i in range(10)]
    return out


def near(docs, **k):
    return sorted(collected(hyperminhash.near_duplicates(docs, **k), "doc_id", "n_shingles", "component_id", "kept"), key=repr)


def near_brute(rows):
    return sorted(((i, n, c, i == c) for i, n, c in jaccard.brute_force(rows, hyperminhash.RULE)), key=repr)


def test_near_duplicates_equal_brute_force(spark, docs_of):
    rows = families(random.Random(5))
    docs = docs_of([(i, t, "en", "s") for i, t in rows])
    for cell in (256, 3):  # one cell for each cluster; leaders first, then pairs of cells
        assert near(docs, cell=cell) == near_brute(rows)


def test_near_duplicates_edge_rows(spark, docs_of):
    rows = [(i, t) for i, t, *_ in EDGE if i is not None] + [(20, "One  two\nthree"), (21, "a\x0bb c")]
    docs = docs_of([(i, t, "en", "s") for i, t in rows] + [(None, "one two three", "en", "s")])
    assert near(docs) == sorted([*near_brute(rows), (None, 1, None, True)], key=repr)
    assert near(docs_of([])) == []


def test_an_id_with_several_texts_is_judged_row_by_row(spark, docs_of):
    rng = random.Random(6)
    a, b = (" ".join(f"{x}{rng.randrange(10**6)}" for _ in range(60)) for x in "ab")
    rows = [(5, a), (5, b), (7, b + " end"), (9, a + " end"), (5, a)]
    got = near(docs_of([(i, t, "en", "s") for i, t in rows]))
    assert got == [(5, 56, 5, True)] * 3 + [(7, 57, 5, False), (9, 57, 5, False)]


def test_registers_and_estimates():
    rng = np.random.default_rng(1)
    s = rng.integers(0, 2**63, size=500, dtype=np.uint64)
    regs = hyperminhash.registers(s)
    h = [int(x) for x in hyperminhash.mixed(s)]
    for bucket in range(hyperminhash.BUCKETS):
        mine = [x >> 7 for x in h if x & 127 == bucket]
        if not mine:
            assert regs[bucket] == 0
            continue
        zeros = 57 - min(mine).bit_length()
        bits = format(min(mine), "057b")[zeros + 1:][:hyperminhash.MANTISSA]
        assert regs[bucket] == (hyperminhash.ZEROS - zeros << hyperminhash.MANTISSA) + int(bits, 2)
    for similar, n in ((0.85, 2000), (0.5, 400), (0.0, 50_000)):
        shared = round(similar * 2 * n / (1 + similar))
        found = []
        for _ in range(60):
            u = rng.integers(0, 2**63, size=2 * n - shared, dtype=np.uint64)
            a, b = (hyperminhash.registers(x)[None] for x in (u[:n], u[n - shared:]))
            found.append(hyperminhash.estimate(np.array([n]), np.array([n]), a, b)[0][0])
        assert abs(np.mean(found) - similar) < 0.02
    # agreements by chance, counted on unrelated sets with registers that differ in few bits only
    assert 5e-5 < hyperminhash.chance_agreement(np.array([5000]), np.array([5000]))[0] < 2e-4


def trie(df, **k):
    names = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
    return sorted(collected(conversations.prefix_trie(df, **k), *names), key=repr)


def trie_brute(rows):
    return sorted(conversations.brute_force(rows), key=repr)


def test_trie_equals_brute_force(spark):
    rng = random.Random(7)
    rows = [(c * rng.choice([1, 1, 7]), rng.choice([t, None, 3]), rng.choice(["u", "a", None]), rng.choice(["x", "é\U0001F600", None, ""]))
            for c in range(90) for t in range(rng.randint(0, 5))]
    rows += [(None, 1, "u", "x"), (-105, 1, "u", "x"), (-100, 1, "u", "yy"), (3, 0, "u", "x"), (3, 0, "u", "x")]
    df = spark.createDataFrame(rows, CONV).withColumns({n: F.lit("x") for n in ("depth", "k1", "pos", "n_convs", "g", "h")})
    for group in (256, 3):  # peeled inside tasks; most levels by a shuffle
        assert trie(df, group=group) == trie_brute(rows)


def test_trie_of_truncated_and_equal_conversations(spark):
    snapshots = [(100 * c, t, "u", f"q{t}") for c in range(9) for t in range(c + 1)]
    same = [(700_000 + c, t, "u", f"{t}" * t) for c in range(12) for t in range(6)]
    df = spark.createDataFrame(snapshots + same, CONV)
    assert trie(df, group=2) == trie_brute(snapshots + same)
    assert trie(spark.createDataFrame([], CONV)) == []
    assert trie(spark.createDataFrame([(106, 0, "u", "x")], CONV)) == trie_brute([(106, 0, "u", "x")])


def test_one_very_long_conversation_is_numbered_over_blocks(spark):
    rows = [(900, t, "u", f"{t % 5}") for t in range(3 * conversations.BLOCK + 5)]
    got = collected(conversations.prefix_trie(spark.createDataFrame(rows, CONV)), "depth", "n_convs", "n_leaves")
    assert sorted(got) == [(d, 1, 1) for d in range(len(rows) + 1)]


def words_of(df):
    return sorted(collected(df, "word", "form", "root", "n", "n_near", "form_n"), key=repr)


def test_spelling_equals_brute_force(spark, docs_of):
    rng = random.Random(8)
    base = ["".join(rng.choice("abcdeé") for _ in range(rng.randint(5, 9))) for _ in range(25)]

    def misspelt(w):
        i = rng.randrange(len(w))
        return rng.choice([w[:i] + w[i + 1:], w[:i] + rng.choice("abÿ") + w[i:], w[:i] + rng.choice("abÀ") + w[i + 1:]])

    rows = []
    for i in range(120):
        words = [w if rng.random() < 0.7 else misspelt(w) for w in rng.choices(base, k=40)]
        rows.append((i, " ".join(words).title() + rng.choice([".", "7", "×÷"]), "en", "s"))
    rows += EDGE + EDGE + [(500 + i, "stepaaa stepaab stepaab stepaab " + "stepabb " * 9, "en", "s") for i in range(4)]
    got = words_of(spelling.spelling_report(docs_of(rows)))
    assert got == sorted(spelling.brute_force([(i, t) for i, t, *_ in rows]), key=repr)
    assert any(root not in (word, form) for word, form, root, *_ in got)  # chains of more than one step
    assert spelling.spelling_report(docs_of([])).count() == 0


def test_spelling_of_long_runs_and_crowded_alphabets(spark, docs_of):
    long = "ab" * 15_000
    crowded = [a + b + c + "xyz" for a in "abcdefghijkl" for b in "abcdefghijkl" for c in "ab"]
    rows = [(i, " ".join([long, long[:-1] + "z", long + "q", *crowded]), "en", "s") for i in range(3)]
    got = words_of(spelling.spelling_report(docs_of(rows), min_count=1))
    assert got == sorted(spelling.brute_force([(i, t) for i, t, *_ in rows], min_count=1), key=repr)


def test_neighbour_keys_are_the_keys_of_the_neighbours():
    for k in (2, 4, len(spelling.LETTERS)):
        letters = sorted(set(spelling.symbols(k)))
        word = "".join(letters[i % len(letters)] for i in (0, 1, 1, 0, 1, 0))
        same = {word} | {word[:i] + c + word[i + 1:] for i in range(6) for c in letters}
        longer = {word[:i] + c + word[i:] for i in range(7) for c in letters}
        shorter = {word[:i] + word[i + 1:] for i in range(6)}
        want = {int(x) for w in (sorted(same), sorted(longer)) for x in spelling.word_keys(w, k)}
        assert set(spelling.neighbour_keys([word], k, False)[0].tolist()) == want
        assert set(spelling.neighbour_keys([word], k, True)[0].tolist()) == set(spelling.word_keys(sorted(shorter), k).tolist())


def test_texts_under_one_id_are_kept_and_linked_by_themselves(spark, docs_of):
    rng = random.Random(11)
    a, b, c = (" ".join(f"{x}{rng.randrange(10**6)}" for _ in range(60)) for x in "abc")
    rows = [(5, a), (5, b), (7, b + " end"), (9, a + " end"), (5, a), (6, c), (6, c), (None, c)]
    docs = docs_of([(i, t, "en", "s") for i, t in rows])
    kept = sorted(collected(jaccard.keep_one(docs, rule=jaccard.Rule(5, 80, 100)), "doc_id", "text"), key=repr)
    assert kept == sorted([(5, a), (5, b), (6, c), (None, c)], key=repr)
    links = sorted(collected(jaccard.link_components(docs), "doc_id", "component_id"), key=repr)
    assert links == sorted([(5, 5)] * 3 + [(6, 6)] * 2 + [(7, 5), (9, 5), (None, None)], key=repr)


def test_working_columns_do_not_clash_with_the_input(spark, docs_of):
    from martspark.llm import decontaminate, lines, quality

    rng = random.Random(12)
    texts = [" ".join(f"w{rng.randrange(10**6)}" for _ in range(40)) + f"\nline {i % 2}" for i in range(30)]
    plain = docs_of([(i, t, "en", "s") for i, t in enumerate(texts)], extra=False)
    odd = plain.withColumns({n: F.lit(f"in {n}") for n in ("__host", "__dropped", "__words", "__kept", "__n_words", "__n_words0",
                                                           "__spans", "__id", "__hash", "__row")})
    bench = spark.createDataFrame([(1, texts[3])], "item_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    for fn in (lambda d: lines.drop_boilerplate(d, length_col="n_chars"), lambda d: quality.keep_good(d, labels),
               lambda d: decontaminate.remove_contaminated(d, bench), jaccard.keep_one):
        got = fn(odd)
        assert got.columns == odd.columns
        assert sorted(map(tuple, got.select(plain.columns).collect())) == sorted(map(tuple, fn(plain).collect()))
        assert {r["__id"] for r in got.select("__id").collect()} == {"in __id"}


def test_quotations_over_lines_and_phrase_places_of_long_texts():
    import time

    from martspark.llm import langid, licenses, toxicity

    text = 'He said "' + "word " * 200 + "\nmore\" and left.\n\nAn open \" mark.\n\nNew “one” here"
    spans = toxicity._quoted_ranges(text)
    assert [text[a] + text[b - 1] for a, b in spans] == ['""', "“”"] and spans[0][1] - spans[0][0] > 1000
    words = [b"cc", b"by"] * 200_000
    start = time.perf_counter()
    assert [w for w, _ in licenses.phrase_places(words)] == list(range(0, 400_000, 2))
    assert time.perf_counter() - start < 5
    assert not langid._LETTER.search("½ ² 12 ٣") and langid._LETTER.search("½ é")
    index = licenses.TemplateIndex({})
    block = [w for _, t in licenses.TEMPLATES[:1] for w in licenses.alnum_words(t)]
    label = licenses.TEMPLATES[0][0]
    twice = block + [b"between"] * 200 + block
    assert [(at, name) for at, name, _ in index.wrapped(twice, {}) if name == label] == [(0, label), (len(block) + 200, label)]
