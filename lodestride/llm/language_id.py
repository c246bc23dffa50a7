"""Language identification by a linear-chain conditional random field over words.

Each word of a text is labelled with a language. A word's features are its prefixes and suffixes
of one to three letters, its letter pairs and triples (with word ends), and the word itself if it
is in the lexicon of frequent training words; all are hashed to a fixed number of weights per
language. Transition weights between the languages of neighbouring words are learned with them,
so forward-backward gives each word's language in its context, and switches inside a text are
followed. A document's language is the one with the largest sum of word marginals; the score is
its share.

The model is fitted by gradient ascent on the likelihood of a bounded sample of labelled
documents (``SAMPLE_DOCS``, dealt evenly over the languages; whole texts, every word labelled with its
document's language), on the driver; it has a fixed size (NO_FEATURE x languages). As each of these is in one
language, sequences spliced from short spans of documents in several languages are added, so that the
transitions of code-switched text are learned. Prediction reads every whole text in tasks.

Runs of over WORD_LETTERS letters (text without spaces, such as Chinese or Thai) are cut into pieces of that size, and
each piece is a word. Sequences of over SEGMENT_WORDS words are cut into chains of that size, whose word marginals are
summed, so memory doesn't grow with a text. The cache of word emissions belongs to a task.

A text that is null or has no letter is ``und`` with score 0. Without any labelled text all are
``und``. Repeated rows are predicted each for itself; other columns are left alone.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lodestride.llm.common import map_tasks
from lodestride.llm.sampling import held_out

BUCKET_BITS = 16
SAMPLE_DOCS = 800
SAMPLE_CHARS = 2_500_000
LEXICON = 5000
NO_FEATURE = (1 << BUCKET_BITS) + LEXICON
ROUNDS = 20
SPLICED = 0.5  # spliced sequences for each document
WORD_LETTERS = 40
SEGMENT_WORDS = 20_000
CHUNK_WORDS = 100_000
CACHE_WORDS = 100_000
LETTERS = re.compile(r"[^\W\d_]+")
SCHEMA = "doc_id long, held_out boolean, lang_pred string, score double"


def words_of(text: str) -> list[str]:
    """Words at white space, long runs of letters in pieces; none if the text has no letter."""
    if not LETTERS.search(text):
        return []
    words = text.lower().split()
    if max(map(len, words)) <= WORD_LETTERS:
        return words
    out = []
    for w in words:
        if len(w) > WORD_LETTERS:
            w = "".join(LETTERS.findall(w)) or w[:1]
        out += [w[i : i + WORD_LETTERS] for i in range(0, len(w), WORD_LETTERS)]
    return out


def segments(words: list[str]) -> list[list[str]]:
    return [words[i : i + SEGMENT_WORDS] for i in range(0, len(words), SEGMENT_WORDS)]


def _hashed(columns: list[np.ndarray]) -> np.ndarray:
    """Bucket of each row of code points."""
    h = np.full(columns[0].shape, len(columns), np.uint64)
    for c in columns:
        h = (h ^ c) * np.uint64(0x100000001B3)
        h ^= h >> np.uint64(29)
    return (h * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - BUCKET_BITS)


def features(words: list[str], lexicon: dict[str, int]) -> np.ndarray:
    """Weight rows of each word's features; unused places hold NO_FEATURE.

    Letter pairs and triples run over the word with a mark at either end, so the first and last
    hold the affixes of one and two letters; affixes of three are added, then the lexicon entry.
    Marks, digits and signs of a word aren't read; a word without a letter has no feature.
    """
    words = [w if w.isalpha() else "".join(LETTERS.findall(w)) for w in words]
    letters = np.array([*words, "   "])[:-1]
    letters = letters.view(np.uint32).reshape(len(words), -1).astype(np.uint64)
    sizes, width, rows = (letters != 0).sum(1), letters.shape[1], np.arange(len(words))
    marked = np.zeros((len(words), width + 4), np.uint64)
    marked[:, 0], marked[:, 1 : width + 1] = 1, letters
    marked[rows, sizes + 1] = 2
    some = (sizes > 0)[:, None]
    places = np.arange(width + 1)[None, :]
    pairs = np.where((places < sizes[:, None] + 1) & some, _hashed([marked[:, i : i + width + 1] for i in range(2)]), NO_FEATURE)
    triples = np.where((places < sizes[:, None]) & some, _hashed([marked[:, i : i + width + 1] for i in range(3)]), NO_FEATURE)
    long = (sizes > 2)[:, None]
    prefix = np.where(long, _hashed([marked[:, i : i + 1] for i in range(4)]), NO_FEATURE)
    suffix = np.where(long, _hashed([marked[rows, np.maximum(sizes - 2 + i, 0)][:, None] for i in range(4)]), NO_FEATURE)
    entry = np.fromiter((lexicon.get(w, NO_FEATURE) for w in words), np.int64, len(words))[:, None]
    return np.concatenate([pairs.astype(np.int64), triples.astype(np.int64), prefix.astype(np.int64), suffix.astype(np.int64), entry], 1)


@dataclass
class Model:
    languages: list[str]
    lexicon: dict[str, int]
    weights: np.ndarray  # (NO_FEATURE + 1) x languages; the last row is 0
    transition: np.ndarray  # languages x languages

    def emissions(self, words: list[str]) -> np.ndarray:
        found = features(words, self.lexicon)
        n = np.maximum(1, (found != NO_FEATURE).sum(1))
        return self.weights[found].sum(1) / np.sqrt(n)[:, None]


def forward_backward(scores: np.ndarray, lengths: np.ndarray, transition: np.ndarray, count_pairs: bool = True) -> tuple[np.ndarray, np.ndarray, float]:
    """Word marginals, summed transition marginals and log of the partition sum of many sequences.

    ``scores``: words x labels, the sequences one after another, longest first. All sequences
    advance together, one word a step.
    """
    k = scores.shape[1]
    starts = np.r_[0, np.cumsum(lengths)[:-1]].astype(np.int64)
    longest = int(lengths[0]) if len(lengths) else 0
    active = np.searchsorted(-lengths, -np.arange(longest), side="left")  # sequences longer than t
    # Word t of all sequences lies together, so each step works on slices.
    at = np.r_[0, np.cumsum(active)].astype(np.int64)
    by_step = starts[np.arange(at[-1]) - np.repeat(at[:-1], active)] + np.repeat(np.arange(longest), active)
    top = scores.max(1)
    emit = np.exp(scores - top[:, None])[by_step]
    step = np.exp(transition - transition.max())
    alpha, norm = np.empty_like(emit), np.empty((len(emit), 1))
    for t in range(longest):
        i, j = at[t], at[t + 1]
        now = emit[i:j] * (alpha[at[t - 1] : at[t - 1] + j - i] @ step if t else 1.0 / k)
        now.sum(1, keepdims=True, out=norm[i:j])
        np.divide(now, norm[i:j], out=alpha[i:j])
    beta, pairs, back = np.ones_like(emit), np.zeros((k, k)), step.T.copy()
    emit /= norm
    for t in range(longest - 2, -1, -1):
        i, j = at[t + 1], at[t + 2]
        coming = emit[i:j] * beta[i:j]
        beta[at[t] : at[t] + j - i] = coming @ back
        if count_pairs:
            pairs += alpha[at[t] : at[t] + j - i].T @ coming
    logz = float(np.log(norm).sum() + top.sum() + transition.max() * (len(emit) - len(lengths)) + np.log(k) * len(lengths))
    out = np.empty_like(emit)
    out[by_step] = alpha * beta
    return out, pairs * step, logz


def spliced(pairs: list[tuple[list[str], str]], n: int) -> list[tuple[list[str], list[str]]]:
    """``n`` sequences of two to four short spans, each of a document in another language than the one before, with a label per word."""
    rng, by = np.random.default_rng(0), {}
    for words, lang in pairs:
        by.setdefault(lang, []).append(words)
    languages, out = sorted(by), []
    for _ in range(n if len(languages) > 1 else 0):
        last, sequence, labels = -1, [], []
        for _ in range(rng.integers(2, 5)):
            last = (last + int(rng.integers(1, len(languages)))) % len(languages) if last >= 0 else int(rng.integers(len(languages)))
            words = by[languages[last]][rng.integers(len(by[languages[last]]))]
            size = min(len(words), int(rng.integers(3, 41)))
            at = int(rng.integers(len(words) - size + 1))
            sequence += words[at : at + size]
            labels += [languages[last]] * size
        out.append((sequence, labels))
    return out


def fit(texts: list[str], langs: list[str], rounds: int = ROUNDS) -> Model | None:
    """CRF of labelled texts, each word with its text's label, and of sequences spliced from them. Adagrad on the whole sample."""
    pairs = [(w, lang) for t, lang in zip(texts, langs) if (w := words_of(t))]
    if not pairs:
        return None
    sequences = [(part, [lang] * len(part)) for words, lang in pairs for part in segments(words)] + spliced(pairs, int(SPLICED * len(pairs)))
    sequences.sort(key=lambda p: (-len(p[0]), p[1]))
    languages = sorted({lang for _, lang in pairs})
    k = len(languages)
    seen = Counter(w for words, _ in pairs for w in set(words))
    frequent = [w for w, n in sorted(seen.items(), key=lambda x: (-x[1], x[0]))[:LEXICON] if n > 2]
    lexicon = {w: (1 << BUCKET_BITS) + i for i, w in enumerate(frequent)}
    vocabulary = {w: i for i, w in enumerate(sorted(seen, key=lambda w: (len(w), w)))}
    ids = np.array([vocabulary[w] for words, _ in sequences for w in words])
    lengths, number = np.array([len(words) for words, _ in sequences]), {lang: i for i, lang in enumerate(languages)}
    labels = np.array([number[lang] for _, each in sequences for lang in each])
    flat, sizes = [], []
    for i in range(0, len(vocabulary), 50_000):
        found = features(list(vocabulary)[i : i + 50_000], lexicon)
        flat.append(found[found != NO_FEATURE])
        sizes.append((found != NO_FEATURE).sum(1))
    flat, sizes = np.concatenate(flat), np.concatenate(sizes)
    word_of, scale = np.repeat(np.arange(len(vocabulary)), sizes), 1 / np.sqrt(np.maximum(1, sizes))[:, None]
    empirical = np.zeros((len(vocabulary), k))
    np.add.at(empirical, (ids, labels), 1.0)
    together, inner = np.zeros((k, k)), np.ones(len(labels), bool)
    inner[np.cumsum(lengths) - 1] = False  # the last word of a sequence has no next one
    pair = np.flatnonzero(inner)
    np.add.at(together, (labels[pair], labels[pair + 1]), 1.0)
    w, t = np.zeros((NO_FEATURE + 1, k)), np.zeros((k, k))
    sum_w, sum_t = np.full((NO_FEATURE + 1, k), 1e-8), np.full((k, k), 1e-8)
    for _ in range(rounds):
        per_word = np.stack([np.bincount(word_of, w[flat, j], len(vocabulary)) for j in range(k)], 1) * scale
        marginals, expected, _ = forward_backward(per_word[ids], lengths, t)
        got = np.stack([np.bincount(ids, marginals[:, j], len(vocabulary)) for j in range(k)], 1)
        diff = (empirical - got) * scale
        grad = np.stack([np.bincount(flat, diff[word_of, j], NO_FEATURE + 1) for j in range(k)], 1) / len(ids) - 1e-6 * w
        grad_t = (together - expected) / len(ids) - 1e-3 * t
        sum_w += grad * grad
        sum_t += grad_t * grad_t
        w += 0.3 * grad / np.sqrt(sum_w)
        t += 0.1 * grad_t / np.sqrt(sum_t)
    return Model(languages, lexicon, w.astype(np.float32), t)


class _Cache:
    """Emissions of the words that a task has met."""

    def __init__(self, model: Model) -> None:
        self.model, self.rows, self.table = model, {}, np.zeros((CACHE_WORDS, len(model.languages)), np.float32)

    def emissions(self, words: list[str]) -> np.ndarray:
        """``words``: at most CHUNK_WORDS + SEGMENT_WORDS."""
        new = list(set(words).difference(self.rows))
        if len(self.rows) + len(new) > len(self.table):
            self.rows, new = {}, list(set(words))
            if len(new) > len(self.table):
                self.table = np.zeros((len(new), len(self.model.languages)), np.float32)
        new.sort(key=len)  # words of alike length make narrow blocks
        at = len(self.rows)
        self.rows.update(zip(new, range(at, at + len(new))))
        for i in range(0, len(new), 8192):
            part = new[i : i + 8192]
            self.table[at + i : at + i + len(part)] = self.model.emissions(part)
        return self.table[np.fromiter(map(self.rows.__getitem__, words), np.int64, len(words))]


def predict(model: Model | None, texts: list[str | None], cache: _Cache | None = None) -> tuple[list[str], np.ndarray]:
    """Language and score of each text."""
    langs, scores = ["und"] * len(texts), np.zeros(len(texts))
    if model is None:
        return langs, scores
    cache = cache or _Cache(model)
    sums = np.zeros((len(texts), len(model.languages)))

    def add(held: list[tuple[int, list[str]]]) -> None:
        held.sort(key=lambda x: -len(x[1]))
        lengths = np.array([len(words) for _, words in held])
        emit = cache.emissions([w for _, words in held for w in words]).astype(np.float64)
        marginals, _, _ = forward_backward(emit, lengths, model.transition, count_pairs=False)
        np.add.at(sums, [i for i, _ in held], np.add.reduceat(marginals, np.r_[0, np.cumsum(lengths)[:-1]], axis=0))

    held, n = [], 0
    for i in sorted((i for i, x in enumerate(texts) if x), key=lambda i: -len(texts[i])):  # texts of alike length together
        for words in segments(words_of(texts[i])):
            held.append((i, words))
            n += len(words)
            if n >= CHUNK_WORDS:
                add(held)
                held, n = [], 0
    if held:
        add(held)
    for i in np.flatnonzero(sums.sum(1) > 0):
        langs[i] = model.languages[sums[i].argmax()]
        scores[i] = min(1.0, float(sums[i].max() / sums[i].sum()))
    return langs, scores


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", sample_docs: int = SAMPLE_DOCS) -> Model | None:
    """Model of a bounded sample of the rows that aren't held out and have a text and a language.

    The sample takes turns over the languages, in each in the order of a hash; it is of at most ``sample_docs``
    documents, and of as many of them, in order, as hold SAMPLE_CHARS characters. Of rows with equal id, language and
    length, one text (the smallest) is in it.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang"))
    rows = rows.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id")) & F.col("doc_id").isNotNull())
    rows = rows.withColumn("n", F.length("text"))
    # Of languages with many documents, those with small hashes alone take part: four times as many as can be drawn.
    each = docs.select(F.col(lang_col).cast("string").alias("lang"), F.col(id_col).cast("long").alias("doc_id"))
    each = each.where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))  # what is held out has no say in it
    each = each.groupBy("lang").agg(F.greatest(F.lit(1.0), F.approx_count_distinct("doc_id") / (4.0 * sample_docs)).alias("one_in"))
    low = (F.xxhash64(F.lit(8), "doc_id").bitwiseAND((1 << 30) - 1) * F.col("one_in")) < float(1 << 30)
    numbers = rows.select("doc_id", "lang", "n").join(each, "lang").where(low).drop("one_in")
    order = F.xxhash64(F.lit(7), "doc_id", "n")
    turn = F.row_number().over(Window.partitionBy("lang").orderBy(order, "doc_id", "n"))
    turns = numbers.distinct().withColumn("turn", turn).where(F.col("turn") <= sample_docs)
    chars, picked = 0, []
    for r in turns.orderBy("turn", order, "doc_id", "n", "lang").limit(sample_docs).collect():  # numbers only
        if chars + r.n <= SAMPLE_CHARS:
            chars += r.n
            picked.append((r.doc_id, r.lang, r.n))
    if not picked:
        return None
    wanted = docs.sparkSession.createDataFrame(picked, "doc_id long, lang string, n int")
    found = rows.join(F.broadcast(wanted), ["doc_id", "lang", "n"]).groupBy("doc_id", "lang", "n").agg(F.min("text").alias("text"))
    texts = sorted((r.doc_id, r.lang, r.n, r.text) for r in found.toLocalIterator())
    return fit([t[3] for t in texts], [t[1] for t in texts])


def identify(docs: DataFrame, model: Model | None = None, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score. Fits a model unless one is given."""
    model = model or train(docs, id_col, text_col, lang_col)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def begin():
        cache = _Cache(shared.value) if shared.value else None

        def batch(b: pa.RecordBatch) -> pa.RecordBatch:
            langs, scores = predict(shared.value, b.column("text").to_pylist(), cache)
            columns = [b.column("doc_id"), b.column("held_out"), pa.array(langs, pa.string()), pa.array(scores, pa.float64())]
            return pa.RecordBatch.from_arrays(columns, names=["doc_id", "held_out", "lang_pred", "score"])

        return batch

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), held_out(F.col(id_col)).alias("held_out"), F.col(text_col).alias("text"))
    return map_tasks(rows, begin, SCHEMA)


def accepted_documents(docs: DataFrame, least_score: float = 0.4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` with a language of at least ``least_score``; ``und`` goes."""
    shared = docs.sparkSession.sparkContext.broadcast(train(docs, id_col, text_col))

    def begin():
        cache = _Cache(shared.value) if shared.value else None

        def batch(b: pa.RecordBatch) -> pa.RecordBatch:
            langs, scores = predict(shared.value, b.column(text_col).to_pylist(), cache)
            return b.filter(pa.array([lang != "und" and s >= least_score for lang, s in zip(langs, scores)], pa.bool_()))

        return batch

    return map_tasks(docs, begin, docs.schema)
