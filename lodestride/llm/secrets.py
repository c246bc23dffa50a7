"""Secret scan: keyword automaton, anchored expressions near its hits, checksums.

An Aho-Corasick automaton finds the keywords of all kinds in one pass over a text; an expression
is tried only where a keyword starts, so a text without keywords costs one pass. Runs of hex
digits have no keyword and are found by one character-class scan. Vendor tokens that embed a
checksum are reported only if it is right.

Kinds, in order: assign, access and hex (as in KINDS), then github and npm (validated). Within a
kind, spans are leftmost and don't overlap. Null texts count as empty and have no span; texts may
have any length; repeated rows are scanned each for itself; other columns are left alone.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from functools import lru_cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestride.llm.common import map_batches, strings

# The patterns that are reported, the least length of the part that counts, and
# the keywords that start them.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ASSIGN_LEAST = 12
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
ACCESS_LEAST = 18
HEX = re.compile(r"[0-9a-f]{16,}")
VENDOR = re.compile(r"(?:gh[pousr]|npm)_([0-9A-Za-z]{30})([0-9A-Za-z]{6})(?![0-9A-Za-z])")
KEYWORDS = {
    "assign": ("password", "passwd", "secret", "token", "apikey", "api_key"),
    "access": ("akia",),
    "github": ("ghp_", "gho_", "ghu_", "ghs_", "ghr_"),
    "npm": ("npm_",),
}
KINDS = ("assign", "access", "hex", "github", "npm")
BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"

SCHEMA = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string"


@lru_cache(1)
def _automaton() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for kind, words in KEYWORDS.items():
        for word in words:
            found.add_word(word, (kind, len(word)))
    found.make_automaton()
    return found


def checksum62(body: str) -> str:
    """CRC-32 of ``body`` as six base-62 digits."""
    n, out = zlib.crc32(body.encode()), ""
    for _ in range(6):
        n, digit = divmod(n, 62)
        out = BASE62[digit] + out
    return out


def _match(kind: str, text: str, at: int) -> tuple[int, bool] | None:
    """End of the match of ``kind`` that starts at ``at``, and whether it counts."""
    if kind == "assign":
        m = ASSIGN.match(text, at)
        return m and (m.end(), len(m[2]) >= ASSIGN_LEAST)
    if kind == "access":
        m = ACCESS.match(text, at)
        return m and (m.end(), m.end() - at >= ACCESS_LEAST)
    m = VENDOR.match(text, at)
    return m and (m.end(), checksum62(m[1]) == m[2])


def find_secrets(text: str) -> list[tuple[int, str, int]]:
    """(start, kind, end) of every secret, by start and then kind, in code points."""
    # The only character that is longer in lower case; anything else keeps its place.
    folded = text.replace("İ", " ").lower()
    hits = sorted((end - length + 1, kind) for end, (kind, length) in _automaton().iter(folded))
    found, free = [], dict.fromkeys(KINDS, 0)
    for at, kind in hits:
        if at >= free[kind] and (m := _match(kind, text, at)):
            free[kind] = m[0]
            if m[1]:
                found.append((at, kind, m[0]))
    found += [(m.start(), "hex", m.end()) for m in HEX.finditer(text)]
    return sorted(found, key=lambda x: (x[0], KINDS.index(x[1])))


def _row(text: str) -> tuple[int, int, int, str, str]:
    found = find_secrets(text)
    base = [x for x in found if x[1] in ("assign", "access", "hex")]
    joined = ",".join(f"{kind}:{start}:{end}" for start, kind, end in base)
    n = [sum(x[1] == kind for x in base) for kind in ("assign", "access", "hex")]
    spans = joined if len(base) == len(found) else ",".join(f"{kind}:{start}:{end}" for start, kind, end in found)
    return (*n, hashlib.sha256(joined.encode()).hexdigest(), spans)


def _batch(batch: pa.RecordBatch) -> pa.RecordBatch:
    rows = [_row(x) for x in strings(batch.column("text"))]
    columns = list(zip(*rows)) if rows else [()] * 5
    kinds = [pa.int64()] * 3 + [pa.string()] * 2
    return pa.RecordBatch.from_arrays(
        [batch.column("doc_id"), *(pa.array(list(c), k) for c, k in zip(columns, kinds))],
        names=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"],
    )


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_assign, n_access, n_hex, base_sha256, spans."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return map_batches(rows, _batch, SCHEMA)
