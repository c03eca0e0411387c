"""Token counts per section by offset-mapped attribution (operator 3).

A document is encoded once, whole.  The byte length of every token gives its
span in the text; the spans are joined to the sections' spans (by binary search
of the section starts, both sides being sorted), and each token is allocated to
exactly one section:

    a token goes to the section that holds most of its bytes; on a tie, to the
    earlier one.

So the sections of a document always add up to the document's tokens.  Sections
are by default the lines of the text, a line's ending newline belonging to it.

The vocabulary is a file of a public tokenizer; its path is a parameter, the
driver reads it and its ranks (a fixed size) travel with the tasks.

Long runs of white space are cut out before the pattern runs, since its look-ahead backtracks over a whole
run.  The pattern takes a run up to its last character, which it leaves to the word that follows (all of the
run at the end of the text); the same cut is made by hand, so the tokens are the same.

Defined results: null and empty texts have no token and no section; repeated
rows are counted each for itself; tables may be empty; extra columns pass.
"""

from __future__ import annotations

import base64
import re

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructField

from .common import with_arrow

TOKENIZER_PATH = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
# Fixed value: the pattern that cuts text before merging, as published with byte-level BPE vocabularies.
SPLIT_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


LONG_RUN = 256
# The characters with the Unicode property White_Space.
_WHITE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_RUN = re.compile(f"[{_WHITE}]{{{LONG_RUN},}}")


def line_starts(data: bytes) -> np.ndarray:
    """Byte offsets at which the lines of ``data`` start (a newline ends its line)."""
    if not data:
        return np.zeros(0, dtype=np.int64)
    ends = np.flatnonzero(np.frombuffer(data, dtype=np.uint8) == 10) + 1
    return np.concatenate(([0], ends[ends < len(data)]))


def allocate(token_bytes: np.ndarray, starts: np.ndarray, total: int) -> tuple[np.ndarray, int]:
    """Tokens per section and the number of tokens that cross a boundary.

    ``token_bytes``: byte length of each token in text order; ``starts``: sorted
    section starts, the first 0; ``total``: bytes of the text."""
    end = np.cumsum(token_bytes)
    begin = end - token_bytes
    first = np.searchsorted(starts, begin, side="right") - 1
    last = np.searchsorted(starts, np.maximum(end - 1, begin), side="right") - 1
    owner = first.copy()
    bounds = np.append(starts, total)
    crossing = np.flatnonzero(last > first)
    for i in crossing.tolist():
        parts = range(first[i], last[i] + 1)
        held = [min(end[i], bounds[s + 1]) - max(begin[i], bounds[s]) for s in parts]
        owner[i] = first[i] + int(np.argmax(held))  # argmax: the earliest of equals
    return np.bincount(owner, minlength=len(starts)).astype(np.int64), len(crossing)


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def encoder(ranks: dict[bytes, int]):
    import tiktoken

    return tiktoken.Encoding("section_counts", pat_str=SPLIT_PATTERN, mergeable_ranks=ranks, special_tokens={})


def whole_encoder(ranks: dict[bytes, int]):
    """``text -> tokens`` of ``encoder``, also for texts with long runs of white space."""
    import tiktoken

    words = encoder(ranks)
    runs = tiktoken.Encoding("runs", pat_str="(?s).+", mergeable_ranks=ranks, special_tokens={})

    def encode(text: str) -> list[int]:
        out, at = [], 0
        for run in _RUN.finditer(text):
            end = run.end() - (run.end() < len(text))
            out += words.encode_ordinary(text[at:run.start()])
            out += runs.encode_ordinary(text[run.start():end])
            at = end
        return out + words.encode_ordinary(text[at:])

    return encode


FIELDS = [StructField("__n_tokens", LongType()), StructField("__sections", ArrayType(LongType())),
          StructField("__crossing", LongType())]


def count_tokens(docs: DataFrame, text_col: str = "text", tokenizer_path: str = TOKENIZER_PATH) -> DataFrame:
    """``docs`` with ``__n_tokens``, ``__sections`` (tokens of each line) and ``__crossing``."""
    shared = docs.sparkSession.sparkContext.broadcast(load_ranks(tokenizer_path))  # about 50,000 entries

    def make():
        ranks = shared.value
        encode = whole_encoder(ranks)
        size = np.zeros(max(ranks.values()) + 1, dtype=np.int64)
        for token, number in ranks.items():
            size[number] = len(token)

        def one(text):
            if not text:
                return 0, [], 0
            data = text.encode("utf-8", "surrogatepass")
            tokens = np.asarray(encode(text), dtype=np.int64)
            sections, crossing = allocate(size[tokens], line_starts(data), len(data))
            return len(tokens), sections.tolist(), crossing

        return one

    return with_arrow(docs, [text_col], make, FIELDS)


def token_report(docs: DataFrame, tokenizer_path: str = TOKENIZER_PATH) -> DataFrame:
    """One row per document: tokens, sections, boundary-crossing tokens, tokens of each section."""
    found = count_tokens(docs.select("doc_id", "text"), tokenizer_path=tokenizer_path)
    return found.select(
        "doc_id", F.col("__n_tokens").alias("n_tokens"), F.size("__sections").cast("long").alias("n_sections"),
        F.col("__crossing").alias("n_crossing"),
        F.coalesce(F.array_max("__sections"), F.lit(0).cast("long")).alias("max_section_tokens"),
        F.array_join(F.transform("__sections", lambda x: x.cast("string")), ",").alias("section_tokens"))
