"""Toxicity score by a factorization machine over hashed terms.

Every distinct term of a text (lower case, without marks around it) is hashed to one of 2^BITS
features. The score is logistic(w0 + sum w_i + sum over pairs <v_i, v_j>): the factors learn pairs
of terms, such as an insult next to the mention of a group, that linear weights alone would score
as the sum of their parts.

The model is fitted on a bounded sample (``SAMPLE_DOCS`` documents, SAMPLE_CHARS characters, whole
texts) of labelled rows that aren't held out. Tasks turn texts to hashed terms; the driver gets
the sample's term numbers and runs Adagrad. A term enters the model by any of three effects on the label: its own
(chi-square LEAST_CHI2), its own among documents that hold a term of the first kind (BESIDE_CHI2), or that of
a pair with another term of PAIR_SHARE of the sample, beyond what both terms' own effects add up to (PAIR_CHI2); so terms that matter in
pairs alone are found. How many terms enter isn't limited; at most (distinct terms of an average document) /
PAIR_SHARE terms are in that share of the sample (25,000 where documents have 250), and pairs are counted for PAIR_BLOCK of them at a time. All terms together spoil the model: with 250 terms a text, recall on held-out rows fell
from over 0.7 to 0.2-0.5. The model has a row for each feature, so its size is fixed. Scoring reads every
whole text in tasks.

Null texts count as empty; a text without known terms has the score of the intercept. Without
labels of both kinds, the score is the share of toxic labels seen (0 if none). Documents with
several label rows are toxic if one says so; of several texts with a sampled id, the smallest is learned from. Repeated
rows are scored each for itself. Other columns are left alone.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestride.llm.common import map_tasks, strings
from lodestride.llm.sampling import bounded, held_out

BITS = 18
SAMPLE_DOCS = 12_000
SAMPLE_CHARS = 40_000_000
LEAST_DOCS = 3
LEAST_CHI2 = 12.0
BESIDE_CHI2 = 16.0
PAIR_CHI2 = 60.0
PAIR_DOCS = 20
PAIR_SHARE = 0.01  # of the sampled documents: all pairs of terms that are in so many are tested
PAIR_BLOCK = 512  # terms whose pairs with all others are counted at once
FACTORS = 6
EPOCHS = 40
BATCH = 128
RATE = 0.15
DECAY = 1e-4
THRESHOLD = 0.7
CACHE_TERMS = 150_000
MARKS = ".,;:!?\"'`()[]{}<>|#$%&*+-/=@\\^_~"
SCHEMA = "doc_id long, held_out boolean, score double, predicted int"


class Hashes:
    """Feature numbers of the terms that a task has met."""

    def __init__(self) -> None:
        self.known: dict[str, int] = {}

    def of(self, text: str) -> np.ndarray:
        """Distinct features of a text, ascending."""
        terms = set(text.lower().split())
        new = terms.difference(self.known)
        if len(self.known) + len(new) > CACHE_TERMS:
            self.known, new = {}, terms
        for term in new:
            bare = term.strip(MARKS)
            self.known[term] = zlib.crc32(bare.encode()) >> (32 - BITS) if bare else -1
        found = np.unique(np.fromiter(map(self.known.__getitem__, terms), np.int32, len(terms)))
        return found[found >= 0]


@dataclass
class Model:
    base: float
    linear: np.ndarray  # of each feature; 0 for those that aren't learned
    factors: np.ndarray  # features x FACTORS

    def score(self, features: list[np.ndarray]) -> np.ndarray:
        return np.exp(-np.logaddexp(0, -self.margin(features)))

    def margin(self, rows: list[np.ndarray]) -> np.ndarray:
        out = np.full(len(rows), self.base, np.float64)
        some = [i for i, r in enumerate(rows) if len(r)]
        if some and len(self.linear):
            flat = np.concatenate([rows[i] for i in some])
            starts = np.cumsum([0, *(len(rows[i]) for i in some[:-1])])
            v = self.factors[flat]
            total = np.add.reduceat(v, starts)
            out[some] += np.add.reduceat(self.linear[flat], starts) + 0.5 * (total * total - np.add.reduceat(v * v, starts)).sum(1)
        return out


def _chi2(seen: np.ndarray, bad: np.ndarray, n: int, positive: float) -> np.ndarray:
    """Chi-square of each feature (in ``seen`` of ``n`` rows, ``bad`` of them labelled 1) against the label; -1 for rare ones."""
    expected = seen * positive / max(n, 1)
    out = (bad - expected) ** 2 / np.maximum(expected * (1 - positive / max(n, 1)) * (1 - seen / (n + 1)), 1e-9)
    return np.where(seen >= LEAST_DOCS, out, -1.0)


def _over(values: np.ndarray, least: float) -> np.ndarray:
    return np.flatnonzero(values > least)


def pair_effects(features: list[np.ndarray], labels: np.ndarray, terms: np.ndarray) -> np.ndarray:
    """Of each of ``terms``, the largest chi-square of a pair with another one beyond both terms' own effects (added as log odds)."""
    place = np.full(1 << BITS, -1, np.int64)
    place[terms] = np.arange(len(terms))
    rows = [p[p >= 0] for p in (place[f] for f in features)]
    n, base = len(labels), labels.mean() if len(labels) else 0.0
    flat, toxic = np.concatenate([np.empty(0, np.int64), *rows]), np.repeat(labels > 0, [len(r) for r in rows])
    seen, bad_seen = np.bincount(flat, minlength=len(terms)), np.bincount(flat[toxic], minlength=len(terms))
    odds = lambda p: np.log(p / (1 - p))
    own = odds((bad_seen + base) / (seen + 1)) - odds(base) if n else seen
    best = np.zeros(len(terms))
    # Counts of a block's pairs with all terms are held at once; documents come in parts.
    for first in range(0, len(terms), PAIR_BLOCK):
        block = slice(first, min(first + PAIR_BLOCK, len(terms)))
        both, bad = np.zeros((2, block.stop - first, len(terms)), np.float32)
        for i in range(0, n, 1024):
            part = rows[i : i + 1024]
            x = np.zeros((len(part), len(terms)), np.float32)
            x[np.repeat(np.arange(len(part)), [len(p) for p in part]), np.concatenate(part)] = 1
            both += x[:, block].T @ x
            x = x[labels[i : i + 1024] > 0]
            bad += x[:, block].T @ x
        for k, i in enumerate(range(first, block.stop)):
            want = 1 / (1 + np.exp(-(odds(base) + own[i] + own)))
            chi2 = (bad[k] - both[k] * want) ** 2 / np.maximum(both[k] * want * (1 - want), 1.0)
            # A term that is almost always beside another has no effect of its own to add.
            apart = (both[k] >= PAIR_DOCS) & (np.minimum(seen[i], seen) - both[k] >= PAIR_DOCS)
            best[i] = np.max(chi2 * apart, initial=0.0)
    return best


def selected_terms(features: list[np.ndarray], labels: np.ndarray) -> np.ndarray:
    """Features of the model, ascending."""

    def effects(rows: list[int]) -> np.ndarray:
        flat = np.concatenate([np.empty(0, np.int64), *(features[i] for i in rows)])
        y = np.repeat(labels[rows], [len(features[i]) for i in rows])
        return _chi2(np.bincount(flat, minlength=1 << BITS), np.bincount(flat, y, 1 << BITS), len(rows), labels[rows].sum())

    everywhere = list(range(len(labels)))
    own = _over(effects(everywhere), LEAST_CHI2)
    known = np.zeros(1 << BITS, bool)
    known[own] = True
    beside = _over(effects([i for i in everywhere if known[features[i]].any()]), BESIDE_CHI2)
    seen = np.bincount(np.concatenate([np.empty(0, np.int64), *features]), minlength=1 << BITS)
    frequent = np.flatnonzero(seen >= max(2 * PAIR_DOCS, PAIR_SHARE * len(labels)))
    paired = frequent[_over(pair_effects(features, labels, frequent), PAIR_CHI2)] if len(frequent) > 1 else frequent[:0]
    return np.unique(np.concatenate([own, beside, paired]))


def fit(features: list[np.ndarray], labels: np.ndarray, epochs: int = EPOCHS, seed: int = 0) -> Model:
    """Model of feature lists and 0/1 labels."""
    n, positive = len(labels), int(labels.sum()) if len(labels) else 0
    share = min(max(positive / n if n else 0.0, 1e-6), 1 - 1e-6)
    base = float(np.log(share / (1 - share)))
    if positive in (0, n):
        return Model(-np.inf if positive == 0 else base, np.zeros(0), np.zeros((0, FACTORS)))
    used = selected_terms(features, labels)
    slot = np.full(1 << BITS, -1, np.int64)
    slot[used] = np.arange(len(used))
    rows = [s[s >= 0] for s in (slot[f] for f in features)]
    rng = np.random.default_rng(seed)
    # Linear weights (column 0) and factors.
    table = np.concatenate([np.zeros((len(used), 1)), rng.normal(0, 0.02, (len(used), FACTORS))], 1)
    sums, sum_b = np.full_like(table, 1e-2), 1e-2
    rate, decay = RATE * np.r_[1.0, [0.3] * FACTORS], DECAY * np.r_[1.0, [10.0] * FACTORS]
    for _ in range(epochs):
        order = rng.permutation(n)
        for i in range(0, n, BATCH):
            part = order[i : i + BATCH]
            sizes = np.array([len(rows[r]) for r in part])
            at, of = np.concatenate([rows[r] for r in part]), np.repeat(np.arange(len(part)), sizes)
            x = table[at]
            total, squares = np.zeros((len(part), FACTORS + 1)), np.zeros(len(part))
            some = np.flatnonzero(sizes)
            if len(some):
                starts = (np.cumsum(sizes) - sizes)[some]
                total[some] = np.add.reduceat(x, starts)
                squares[some] = np.add.reduceat((x[:, 1:] ** 2).sum(1), starts)
            margin = base + total[:, 0] + 0.5 * ((total[:, 1:] ** 2).sum(1) - squares)
            error = 1 / (1 + np.exp(-margin)) - labels[part]
            touched, where = np.unique(at, return_inverse=True)
            g = error[of][:, None] * np.concatenate([np.ones((len(at), 1)), total[of, 1:] - x[:, 1:]], 1)
            grad = np.stack([np.bincount(where, g[:, j], len(touched)) for j in range(FACTORS + 1)], 1) + decay * table[touched]
            sums[touched] += grad * grad
            table[touched] -= rate * grad / np.sqrt(sums[touched])
            sum_b += error.sum() ** 2
            base -= RATE * error.sum() / np.sqrt(sum_b)
    linear, factors = np.zeros(1 << BITS, np.float32), np.zeros((1 << BITS, FACTORS), np.float32)
    linear[used], factors[used] = table[:, 0], table[:, 1:]
    return Model(base, linear, factors)


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", sample_docs: int = SAMPLE_DOCS) -> Model:
    """Model of a bounded sample of the labelled rows that aren't held out."""
    known = labels.where(F.col(label_col).isNotNull()).groupBy(F.col(id_col).cast("long").alias("doc_id")).agg(F.max(F.col(label_col).cast("int")).alias("label"))
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(text_col, F.lit("")).alias("text")).where(~held_out(F.col("doc_id")))
    sizes = texts.select("doc_id", F.length("text").alias("n")).distinct().join(known, "doc_id")
    picked, chars = {}, 0
    for r in bounded(sizes, sample_docs, "doc_id", "n").collect():
        if r.doc_id not in picked and chars + r.n <= SAMPLE_CHARS:
            chars += r.n
            picked[r.doc_id] = r.label
    if not picked:
        return fit([], np.zeros(0))
    wanted = docs.sparkSession.createDataFrame([(i,) for i in picked], "doc_id long")  # at most sample_docs rows
    sampled = texts.join(F.broadcast(wanted), "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"))

    def begin():
        hashes = Hashes()

        def batch(b: pa.RecordBatch) -> pa.RecordBatch:
            found = [hashes.of(t) for t in strings(b.column("text"))]
            return pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(found, pa.list_(pa.int32()))], names=["doc_id", "features"])

        return batch

    got = map_tasks(sampled, begin, "doc_id long, features array<int>").toArrow().sort_by("doc_id")
    lists = got.column("features").combine_chunks()
    cuts = lists.offsets.to_numpy()
    flat = lists.values.to_numpy()
    features = [flat[i:j] for i, j in zip(cuts[:-1], cuts[1:])]
    return fit(features, np.array([picked[i] for i in got.column("doc_id").to_pylist()], float))


def score_toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted."""
    shared = docs.sparkSession.sparkContext.broadcast(train(docs, labels, id_col, text_col, label_col))

    def begin():
        hashes = Hashes()

        def batch(b: pa.RecordBatch) -> pa.RecordBatch:
            texts, score = strings(b.column("text")), []
            for i in range(0, len(texts), 256):  # bounds the rows of factors held at once
                score.append(shared.value.score([hashes.of(t) for t in texts[i : i + 256]]))
            score = np.concatenate([np.empty(0), *score])
            columns = [pa.array(score, pa.float64()), pa.array((score >= threshold).astype(np.int32))]
            return pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("held_out"), *columns], names=["doc_id", "held_out", "score", "predicted"])

        return batch

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), held_out(F.col(id_col)).alias("held_out"), F.col(text_col).alias("text"))
    return map_tasks(rows, begin, SCHEMA)
