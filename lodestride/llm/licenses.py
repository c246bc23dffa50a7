"""License scan: winnowed fingerprints pick candidates, banded alignment confirms them.

Templates are license notices and the full texts of short licenses (longer licenses are found by their notices). Words are
runs of letters and digits, in lower case. Fingerprints are pairs of neighbouring words; of a template's, winnowing keeps the
smallest hash of each window (all, where the template is short), in an inverted index from pair to places. A pair of the text
that is in the index gives a diagonal (place in the text less place in the template). Of n template words, any 80 % that
match with words changed or left out hold a run of four equal words (two, for under 16 words), and so a fingerprint. A diagonal
goes on where enough of the template's places have an equal word within the band around it, which no match can lack. The
template is then aligned to the text in the band, with one point for an equal word and one off for an edit. A
template counts where at least ``LEAST_COVERAGE`` of its words match in order; the best of overlapping places is reported.

The index holds templates alone, so its size is fixed. Null and empty texts have no match; texts
may have any length; repeated rows are scanned each for itself; other columns are left alone.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestride.llm.common import map_batches, strings
from lodestride.llm.license_texts import TEMPLATES

SHINGLE = 2
WINDOW = 3  # of templates with at least SHORT words; 1 for others
SHORT = 16
LEAST_COVERAGE = 0.8
WORD = re.compile(r"[^\W_]+")
SCHEMA = "doc_id long, license string, template int, start long, `end` long, matched_words int, template_words int, coverage double"

def words_of(text: str) -> list[str]:
    return WORD.findall(text.lower())


def winnow(hashes: list[int], window: int = WINDOW) -> list[int]:
    """Places of the smallest hash (the last of equals) in every window; all if there is none full."""
    if len(hashes) < window:
        return list(range(len(hashes)))
    return sorted({max(range(i, i + window), key=lambda j: (-hashes[j], j)) for i in range(len(hashes) - window + 1)})


def _mixed(codes: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        h = codes.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return h ^ (h >> np.uint64(32))


@dataclass
class Index:
    """Inverted index of the templates' winnowed fingerprints, and their words as numbers (from 1; 0: any other word)."""

    templates: tuple[tuple[str, str], ...]
    words: list[list[str]] = field(default_factory=list)
    vocabulary: dict[str, int] = field(default_factory=dict)
    numbers: list[np.ndarray] = field(default_factory=list)
    keys: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))  # sorted fingerprints, each with template and place
    of: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    at: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    members: np.ndarray = field(default_factory=lambda: np.zeros((0, 1), bool))  # template x word number

    def __post_init__(self) -> None:
        self.words = [words_of(t) for _, t in self.templates]
        for word in sorted({w for ws in self.words for w in ws}):
            self.vocabulary[word] = len(self.vocabulary) + 1
        self.numbers = [np.array([self.vocabulary[w] for w in ws], np.int64) for ws in self.words]
        self.members = np.zeros((len(self.words), len(self.vocabulary) + 1), bool)
        found = []
        for t, numbers in enumerate(self.numbers):
            self.members[t, numbers] = True
            codes = self.fingerprints(numbers)
            kept = winnow(_mixed(codes).tolist(), WINDOW if len(numbers) >= SHORT else 1)
            found += [(int(codes[i]), t, i) for i in kept]
        if found:
            self.keys, self.of, self.at = (np.array(x, np.int64) for x in zip(*sorted(found)))

    def fingerprints(self, numbers: np.ndarray) -> np.ndarray:
        """Codes of all pairs of neighbours; a lone word is paired with nothing."""
        nothing = np.zeros(SHINGLE - 1, np.int64)
        padded = numbers if len(numbers) >= SHINGLE else np.r_[numbers, nothing]
        return padded[:-1] * (len(self.vocabulary) + 1) + padded[1:]

    def candidates(self, numbers: np.ndarray) -> list[tuple[int, np.ndarray]]:
        """(template, ascending diagonals) that a fingerprint of the text hits."""
        if not len(numbers) or not len(self.keys):
            return []
        codes = self.fingerprints(numbers)
        low, high = np.searchsorted(self.keys, codes), np.searchsorted(self.keys, codes, side="right")
        place = np.flatnonzero((high > low) & (codes > 0))
        if not len(place):
            return []
        n = (high - low)[place]
        hit = np.repeat(low[place] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        pairs = np.unique(np.stack([self.of[hit], np.repeat(place, n) - self.at[hit]], 1), axis=0)
        cuts = np.flatnonzero(np.diff(pairs[:, 0])) + 1
        return [(int(part[0, 0]), part[:, 1]) for part in np.split(pairs, cuts)]

    def enough(self, t: int, diagonals: np.ndarray, numbers: np.ndarray) -> list[tuple[int, int]]:
        """Those of ascending ``diagonals`` on which enough places of template ``t`` have an equal word in the band around them, with how many have."""
        own, out = self.numbers[t], []
        n, band = len(own), band_of(len(own))
        need = math.ceil(LEAST_COVERAGE * n - 1e-9)
        # Most diagonals end here: the text around them has too few words of the template.
        known = np.r_[0, np.cumsum(self.members[t][numbers])]
        inside = known[np.clip(diagonals + n + band, 0, len(numbers))] - known[np.clip(diagonals - band, 0, len(numbers))]
        diagonals = diagonals[inside >= need]
        if not len(diagonals):
            return out
        for run in np.split(diagonals, np.flatnonzero(np.diff(diagonals) > n + 2 * band) + 1):
            first, last = int(run[0]) - band, int(run[-1]) + n + band
            text = numbers[max(0, first) : last]
            at = run - band - max(0, first)  # of the band's first place for template word 0
            count = np.zeros(len(run), np.int32)
            for i, word in enumerate(own):
                total = np.r_[0, np.cumsum(text == word)]
                count += total[np.clip(at + i + 2 * band + 1, 0, len(text))] > total[np.clip(at + i, 0, len(text))]
            out += zip(run[count >= need].tolist(), count[count >= need].tolist())
        return out


def band_of(n: int) -> int:
    return max(2, -(-n // 5))


@lru_cache(4)
def index_of(templates: tuple[tuple[str, str], ...] = TEMPLATES) -> Index:
    return Index(templates)


def align(template: list[str], text: list[str], at: int, band: int) -> tuple[int, int, int]:
    """Best alignment of the whole template to words near ``at``: matched words, first and last word + 1 in ``text``.

    Cell j of row i is template word i against text word at + i + j - band.
    """
    n, width = len(template), 2 * band + 1
    worst = -(10**9)
    # Each cell: score, matched words, first and last matched place.
    row = [(0, 0, -1, -1)] * width
    for i, word in enumerate(template):
        new = []
        for j in range(width):
            p = at + i + j - band
            score, matched, first, last = row[j]
            inside = 0 <= p < len(text)
            if inside and text[p] == word:
                best = (score + 1, matched + 1, p if first < 0 else first, p)
            else:
                best = (score - 1, matched, first, last) if inside else (worst, 0, -1, -1)
            if j + 1 < width and row[j + 1][0] - 1 > best[0]:  # the template word is left out
                best = (row[j + 1][0] - 1, *row[j + 1][1:])
            if new and inside and new[-1][0] - 1 > best[0]:  # the text has a word more
                best = (new[-1][0] - 1, *new[-1][1:])
            new.append(best)
        row = new
    _, matched, first, last = max(row, key=lambda c: (c[0], c[1]))
    return matched, first, last + 1


def find_licenses(text: str, index: Index) -> list[tuple[int, int, int, int]]:
    """(template, start, end, matched words) of every match, in code points."""
    words = words_of(text)
    numbers = np.fromiter((index.vocabulary.get(w, 0) for w in words), np.int64, len(words))
    found: list[tuple[int, int, int, int]] = []
    for t, hits in index.candidates(numbers):
        template, band = index.words[t], band_of(len(index.words[t]))
        # A match leaves out so many of the template's words at most, and strays by a band at most: so far from its diagonal it begins.
        reach = len(template) - math.ceil(LEAST_COVERAGE * len(template) - 1e-9) + band
        for at, most in index.enough(t, hits, numbers):
            last_one = found[-1] if found and found[-1][0] == t else None
            if last_one and at + reach < last_one[2] and most <= last_one[3]:
                continue  # it would overlap the last match and can't match more words
            matched, first, last = align(template, words, at, band)
            if matched >= LEAST_COVERAGE * len(template):
                if last_one and first < last_one[2]:
                    if matched > last_one[3]:
                        found[-1] = (t, first, last, matched)
                else:
                    found.append((t, first, last, matched))
    if not found:
        return []
    spans = _word_spans(text, len(words))
    return [(t, spans[first][0], spans[last - 1][1], matched) for t, first, last, matched in found]


def _word_spans(text: str, n: int) -> list[tuple[int, int]]:
    """Code point spans of the words, in the text as it is."""
    folded = text.lower()
    spans = [m.span() for m in WORD.finditer(folded)]
    if len(folded) != len(text):  # a character that is longer in lower case
        origin = [i for i, c in enumerate(text) for _ in c.lower()]
        spans = [(origin[a], origin[b - 1] + 1) for a, b in spans] if len(origin) == len(folded) else [m.span() for m in WORD.finditer(text)]
    return spans


def scan_licenses(docs: DataFrame, templates: tuple[tuple[str, str], ...] = TEMPLATES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per match: doc_id, license, template (its number), start, end, matched_words, template_words, coverage."""

    def batch(b: pa.RecordBatch) -> pa.RecordBatch | None:
        index = index_of(templates)
        at, rows = [], []
        for i, text in enumerate(strings(b.column("text"))):
            for t, start, end, matched in find_licenses(text, index):
                n = len(index.words[t])
                at.append(i)
                rows.append((templates[t][0], t, start, end, matched, n, matched / n))
        if not rows:
            return None
        kinds = [pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.float64()]
        columns = [pa.array(c, k) for c, k in zip(zip(*rows), kinds)]
        names = ["doc_id", "license", "template", "start", "end", "matched_words", "template_words", "coverage"]
        return pa.RecordBatch.from_arrays([b.column("doc_id").take(pa.array(at)), *columns], names=names)

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return map_batches(rows, batch, SCHEMA)
