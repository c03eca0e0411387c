"""Secret scans with an incremental blob ledger (operator 8).

Every text version is content-addressed (SHA-256).  Only pairs of (blob, rule
version) that the ledger does not hold yet are scanned, each once however many
paths carry it; findings are joined back to all paths.  The ledger is a Parquet
table that a later run passes in again.

Copies are reduced before the shuffle (partial aggregation per map task) and the
join back is on the blob id with short rows, which adaptive execution splits
when one blob is held by very many paths.

Defined results: a null text is the empty blob; repeated rows are separate
paths; a null path id is a path like any other; tables may be empty.
"""

from __future__ import annotations

import hashlib
import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

from ..plans.stage import stage
from .common import with_arrow

RULE_VERSION = 1
# Kinds in the order in which spans at one start are listed.
KINDS = ("assign", "access", "hex", "pem", "github", "jwt")

_ASSIGN = re.compile(r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                     re.ASCII)
_KEYWORD_TAIL = re.compile(r"(?i:password|passwd|secret|token|api_?key)", re.ASCII)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
# a run shorter than 24 is dropped anyway, and a longest run holds no second match
_HEX = re.compile(r"[0-9a-f]{24,}")
# the method's own rules
_EXTRA = (
    (3, re.compile(r"-----BEGIN [A-Z ]*PRIVATE KEY-----")),
    (4, re.compile(r"gh[pousr]_[A-Za-z0-9]{36,}")),
    (5, re.compile(r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}")),
)
FINDING = StructType([StructField("start", LongType()), StructField("kind", IntegerType()),
                      StructField("end", LongType())])


def scan_text(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) in code points, sorted."""
    out = []
    if _KEYWORD_TAIL.search(text):
        out += [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if len(m.group(1)) >= 6]
    out += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 20]
    out += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    for kind, rule in _EXTRA:
        out += [(m.start(), kind, m.end()) for m in rule.finditer(text)]
    return sorted(out)


def blob_id(text_col: str):
    return F.sha2(F.coalesce(F.col(text_col), F.lit("")).cast("binary"), 256)


def scan_unseen(versions: DataFrame, ledger: DataFrame | None = None, text_col: str = "text",
                rule_version: int = RULE_VERSION) -> DataFrame:
    """New ledger rows (blob, rule_version, findings): each blob of ``versions``
    that ``ledger`` does not hold under ``rule_version`` is scanned once."""
    blobs = versions.select(blob_id(text_col).alias("blob"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    if ledger is not None:
        blobs = blobs.join(ledger.where(F.col("rule_version") == rule_version).select("blob"), "blob", "left_anti")
    blobs = blobs.dropDuplicates(["blob"])

    def make():
        return lambda text: ([{"start": s, "kind": k, "end": e} for s, k, e in scan_text(text)],)

    scanned = with_arrow(blobs, ["text"], make, [StructField("findings", ArrayType(FINDING))])
    return scanned.select("blob", F.lit(rule_version).alias("rule_version"), "findings")


def findings_by_path(versions: DataFrame, ledger: DataFrame, path_cols: list[str], text_col: str = "text",
                     rule_version: int = RULE_VERSION) -> DataFrame:
    """One row per path (row of ``versions``) with the findings of its blob."""
    paths = versions.select(*[F.col(f"`{c}`") for c in path_cols], blob_id(text_col).alias("__blob"))
    known = ledger.where(F.col("rule_version") == rule_version).select(F.col("blob").alias("__blob"), "findings")
    return paths.join(known, "__blob")


def secret_report(docs: DataFrame) -> DataFrame:
    """The digest of the contract: one row per document."""
    ledger = stage(scan_unseen(docs), "secret-ledger")
    found = findings_by_path(docs, ledger, ["doc_id"])
    names = F.array(*[F.lit(k) for k in KINDS])

    def text_of(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(
            ":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")

    base = F.filter("findings", lambda s: s["kind"] < 3)

    def count(kind):
        return F.size(F.filter("findings", lambda s: s["kind"] == kind)).cast("long")

    return found.select("doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
                        F.sha2(text_of(base).cast("binary"), 256).alias("base_sha256"),
                        text_of(F.col("findings")).alias("spans"))


def brute_force(text: str | None):
    """(n_assign, n_access, n_hex, base_sha256) by plain, unshortened patterns."""
    t = text or ""
    key = "(" + "|".join("".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in w)
                         for w in ("password", "passwd", "secret", "token")) + "|[aA][pP][iI]_?[kK][eE][yY])"
    spans = []
    for m in re.finditer(key + r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", t):
        if len(m.group(2)) >= 6:
            spans.append((m.start(), 0, m.end()))
    spans += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", t) if len(m.group()) >= 20]
    spans += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", t) if len(m.group()) >= 24]
    text_ = ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in sorted(spans))
    n = [sum(k == i for _, k, _ in spans) for i in range(3)]
    return (*n, hashlib.sha256(text_.encode()).hexdigest())


LEDGER = StructType([StructField("blob", StringType()), StructField("rule_version", IntegerType()),
                     StructField("findings", ArrayType(FINDING))])
