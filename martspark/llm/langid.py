"""Language identification with a byte-level bidirectional GRU (operator 2).

Two gated recurrent networks read the bytes of a text forwards and backwards;
every position gets a language distribution from both states, and the document's
probabilities are the mean of the log probabilities over all positions of the
whole text, normalised.  Texts are read as segments of ``SEGMENT`` bytes, all of
them, so that many positions are computed at once and memory stays bounded.

The network is trained here, in numpy, by backpropagation through time, on a
bounded, documented sample: per language the first ``FIT_DOCS`` labelled
documents by hash of the id, and from each of them up to ``FIT_SEGMENTS``
evenly spaced segments; more than ``MAX_LANGS`` languages are an error.  Training is seeded, so reruns agree.  Scoring runs in Arrow
batches without a shuffle; the model (some thousand numbers) travels with the tasks.

Defined results: a null text or one without a letter is ``und`` with score 0;
null languages are not learned from; without any labelled text every document
is ``und``; repeated rows are scored each; tables may be empty.
"""

from __future__ import annotations

import numpy as np
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField

from ..plans.stage import stage
from ..plans.topk import top_k_per_group
from .common import with_arrow_batches

HIDDEN = 8
SEGMENT = 64
FIT_DOCS = 250        # documents per language
FIT_SEGMENTS = 6      # segments per document
MAX_LANGS = 400
STEPS = 500
BATCH = 192
RATE = 0.02
SEED = 5
_ROWS = 2048          # segments computed together
_LETTER = regex.compile(r"\p{L}")


def segments_of(data: bytes, size: int = SEGMENT) -> np.ndarray:
    """The whole text as rows of ``size`` bytes, padded with byte 0."""
    rows = -(-len(data) // size)
    out = np.zeros(rows * size, dtype=np.uint8)
    out[:len(data)] = np.frombuffer(data, dtype=np.uint8)
    return out.reshape(rows, size)


def init(langs: int, hidden: int = HIDDEN, seed: int = SEED) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)
    p = {}
    for side in "fb":
        p[f"x{side}"] = rng.normal(0, 0.3, (256, 3 * hidden))            # bytes to reset, update, candidate
        p[f"h{side}"] = rng.normal(0, 0.3, (hidden, 3 * hidden))         # state to the same
        p[f"c{side}"] = np.zeros(hidden)                                 # bias of the state's candidate part
    p["out"] = rng.normal(0, 0.3, (2 * hidden, langs))
    p["bias"] = np.zeros(langs)
    return {k: v.astype(np.float32) for k, v in p.items()}


def _sigmoid(a: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * a) + 0.5


def run_gru(x: np.ndarray, p: dict, side: str, keep: bool = False):
    """States (time, rows, hidden) of one direction over byte rows ``x`` (rows, time);
    with ``keep`` also what the backward pass needs."""
    hidden = p[f"h{side}"].shape[0]
    rows, time = x.shape
    order = range(time) if side == "f" else range(time - 1, -1, -1)
    h = np.zeros((rows, hidden), dtype=np.float32)
    states = np.empty((time, rows, hidden), dtype=np.float32)
    kept = {}
    for t in order:
        a = p[f"x{side}"][x[:, t]]
        u = h @ p[f"h{side}"]
        gates = _sigmoid(a[:, :2 * hidden] + u[:, :2 * hidden])
        r, z = gates[:, :hidden], gates[:, hidden:]
        m = u[:, 2 * hidden:] + p[f"c{side}"]
        n = np.tanh(a[:, 2 * hidden:] + r * m)
        new = n + z * (h - n)
        if keep:
            kept[t] = (h, r, z, m, n)
        h = new
        states[t] = h
    return (states, kept) if keep else states


def _scorer(p: dict):
    """The same states as ``run_gru`` without what training keeps: arrays are
    reused, and the gates' factors of a half are folded into the weights."""
    hidden, sides = p["hf"].shape[0], []
    for side in "fb":
        x, h = p[f"x{side}"], p[f"h{side}"]
        sides.append([np.ascontiguousarray(w, dtype=np.float32) for w in
                      (x[:, :2 * hidden] / 2, x[:, 2 * hidden:], h[:, :2 * hidden] / 2, h[:, 2 * hidden:],
                       p[f"c{side}"], p["out"][:hidden] if side == "f" else p["out"][hidden:])])

    def score(x: np.ndarray) -> np.ndarray:
        rows, time = x.shape
        xt = np.ascontiguousarray(x.T)
        z = np.empty((time, rows, len(p["bias"])), dtype=np.float32)
        gates, n = np.empty((rows, 2 * hidden), np.float32), np.empty((rows, hidden), np.float32)
        u, m, o = np.empty_like(gates), np.empty_like(n), np.empty((rows, z.shape[2]), np.float32)
        for k, (xg, xn, hg, hn, c, out) in enumerate(sides):
            h = np.zeros((rows, hidden), dtype=np.float32)
            for t in range(time) if k == 0 else range(time - 1, -1, -1):
                np.take(xg, xt[t], axis=0, out=gates, mode="clip")
                gates += np.matmul(h, hg, out=u)
                np.tanh(gates, out=gates)
                gates *= 0.5
                gates += 0.5
                np.matmul(h, hn, out=m)
                m += c
                m *= gates[:, :hidden]
                np.take(xn, xt[t], axis=0, out=n, mode="clip")
                n += m
                np.tanh(n, out=n)
                h -= n
                h *= gates[:, hidden:]
                h += n
                if k == 0:
                    np.matmul(h, out, out=z[t])
                else:
                    z[t] += np.matmul(h, out, out=o)
        z += p["bias"]
        z -= z.max(axis=-1, keepdims=True)
        z -= np.log(np.exp(z).sum(axis=-1, keepdims=True))
        return z

    return score


def log_probs(x: np.ndarray, p: dict) -> np.ndarray:
    """Log probability of every language at every position: (time, rows, langs)."""
    return _scorer(p)(x)


def gradients(x: np.ndarray, y: np.ndarray, p: dict) -> tuple[float, dict]:
    """Mean cross-entropy over the positions that hold text, and its gradients by backpropagation through time."""
    hidden = p["hf"].shape[0]
    rows, time = x.shape
    (sf, kf), (sb, kb) = run_gru(x, p, "f", True), run_gru(x, p, "b", True)
    s = np.concatenate([sf, sb], axis=-1)
    z = s @ p["out"] + p["bias"]
    z -= z.max(axis=-1, keepdims=True)
    q = np.exp(z)
    q /= q.sum(axis=-1, keepdims=True)
    mask = (x.T != 0).astype(np.float32)
    total = max(1.0, float(mask.sum()))
    picked = q[:, np.arange(rows), y]
    loss = float(-(np.log(picked + 1e-12) * mask).sum() / total)
    dz = q
    dz[:, np.arange(rows), y] -= 1
    dz *= (mask / total)[:, :, None]
    g = {k: np.zeros_like(v) for k, v in p.items()}
    g["out"] = np.einsum("trh,trl->hl", s, dz)
    g["bias"] = dz.sum(axis=(0, 1))
    ds = dz @ p["out"].T
    for side, kept, own in (("f", kf, ds[:, :, :hidden]), ("b", kb, ds[:, :, hidden:])):
        back = range(time - 1, -1, -1) if side == "f" else range(time)
        w = p[f"h{side}"]
        dh = np.zeros((rows, hidden), dtype=np.float32)
        for t in back:
            h, r, z_, m, n = kept[t]
            d = dh + own[t]
            dn = d * (1 - z_) * (1 - n * n)
            dzg = d * (h - n) * z_ * (1 - z_)
            dr = dn * m * r * (1 - r)
            dm = dn * r
            du = np.concatenate([dr, dzg, dm], axis=1)
            da = np.concatenate([dr, dzg, dn], axis=1)
            np.add.at(g[f"x{side}"], x[:, t], da)
            g[f"h{side}"] += h.T @ du
            g[f"c{side}"] += dm.sum(axis=0)
            dh = d * z_ + du @ w.T
    return loss, g


def train(x: np.ndarray, y: np.ndarray, langs: int, steps: int = STEPS, batch: int = BATCH, rate: float = RATE,
          seed: int = SEED) -> dict[str, np.ndarray]:
    """Adam over balanced batches."""
    p = init(langs, seed=seed)
    rng = np.random.default_rng(seed)
    by = [np.flatnonzero(y == k) for k in range(langs)]
    m = {k: np.zeros_like(v) for k, v in p.items()}
    v = {k: np.zeros_like(w) for k, w in p.items()}
    for step in range(1, steps + 1):
        pick = np.concatenate([rng.choice(i, max(1, batch // langs)) for i in by])
        _, g = gradients(x[pick], y[pick], p)
        now = rate * min(1.0, 2 * (1 - step / (steps + 1)))
        for k in p:
            m[k] = 0.9 * m[k] + 0.1 * g[k]
            v[k] = 0.99 * v[k] + 0.01 * g[k] ** 2
            p[k] = (p[k] - now * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(v[k] / (1 - 0.99 ** step)) + 1e-8)).astype(np.float32)
    return p


def is_held_out(id_col: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
        fit_docs: int = FIT_DOCS):
    """(languages, parameters), or None without labelled text."""
    known = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).rlike(r"\p{L}") & ~is_held_out(id_col))
    named = known.select(F.col(id_col).alias("__id"), F.col(lang_col).alias("__lang")).distinct()
    ids = top_k_per_group(named, ["__lang"], [F.xxhash64("__id"), F.col("__id")], fit_docs, ["__id"])
    ids = stage(ids.select("__id", "__lang"), "fit-ids")
    if (found := ids.select("__lang").distinct().count()) > MAX_LANGS:
        raise ValueError(f"{found} languages, more than {MAX_LANGS}")
    # at most fit_docs * MAX_LANGS ids; an id gives one of its texts, a text at most FIT_SEGMENTS segments
    step = F.greatest(F.lit(SEGMENT), F.floor(F.octet_length(F.col(text_col)) / FIT_SEGMENTS)).cast("int")
    data = F.col(text_col).cast("binary")
    parts = F.transform(F.sequence(F.lit(0), F.lit(FIT_SEGMENTS - 1)),
                        lambda i: F.substring(data, (i * step + 1), F.lit(SEGMENT)))
    rows = (known.join(F.broadcast(ids), (known[id_col] == F.col("__id")) & (known[lang_col] == F.col("__lang")))
            .groupBy("__id", "__lang").agg(F.min(parts).alias("parts"))
            .orderBy("__lang", F.xxhash64("__id"), "__id").collect())
    langs = sorted({r["__lang"] for r in rows})
    if not langs:
        return None
    x = [(langs.index(r["__lang"]), bytes(b)) for r in rows for b in r["parts"] if len(b) > SEGMENT // 4 or b == r["parts"][0]]
    y = np.array([k for k, _ in x])
    return langs, train(np.concatenate([segments_of(b)[:1] for _, b in x]), y, len(langs))


def pooled(texts: list[str | None], langs: list[str], p: dict) -> tuple[list[str], list[float]]:
    """Language and score of each text, every byte of it labelled."""
    names, scores = ["und"] * len(texts), [0.0] * len(texts)
    sums = np.zeros((len(texts), len(langs)))
    sizes = np.ones(len(texts))
    waiting, owners, held = [], [], 0
    score = _scorer(p)

    def flush():
        nonlocal held
        if not held:
            return
        x, own = np.concatenate(waiting), np.concatenate(owners)
        for i in range(0, len(x), _ROWS):
            part = x[i:i + _ROWS]
            lp = score(part) * (part.T != 0)[:, :, None]
            np.add.at(sums, own[i:i + _ROWS], lp.sum(axis=0))
        waiting.clear()
        owners.clear()
        held = 0

    letters = [bool(t) and _LETTER.search(t) is not None for t in texts]
    for k, (t, ok) in enumerate(zip(texts, letters, strict=True)):
        if not ok:
            continue
        rows = segments_of(t.encode("utf-8", "surrogatepass"))
        sizes[k] = rows.size
        waiting.append(rows)
        owners.append(np.full(len(rows), k))
        held += len(rows)
        if held >= 8 * _ROWS:
            flush()
    flush()
    # the mean log probability of a position, sharpened as if a segment were one observation
    z = sums / sizes[:, None] * 8
    z -= z.max(axis=1, keepdims=True)
    q = np.exp(z)
    q /= q.sum(axis=1, keepdims=True)
    best = q.argmax(axis=1)
    for k, ok in enumerate(letters):
        if ok:
            names[k], scores[k] = langs[best[k]], float(q[k, best[k]])
    return names, scores


def predict(docs: DataFrame, model, text_col: str = "text") -> DataFrame:
    """``docs`` with ``__lang`` and ``__score``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        if shared.value is None:
            return lambda texts: [["und"] * len(texts), [0.0] * len(texts)]
        langs, p = shared.value
        return lambda texts: list(pooled(texts, langs, p))

    return with_arrow_batches(docs, [text_col], make, [StructField("__lang", StringType()),
                                                       StructField("__score", DoubleType())])


def language_report(docs: DataFrame) -> DataFrame:
    """The digest of the contract: one row per document."""
    model = fit(docs.select("doc_id", "text", "lang"))
    out = predict(docs.select("doc_id", "text"), model)
    return out.select("doc_id", is_held_out().alias("held_out"), F.col("__lang").alias("lang_pred"),
                      F.col("__score").alias("score"))
