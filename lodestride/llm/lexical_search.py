"""Ranked lexical search: MaxScore over shards of the documents, in 64-bit integers.

Items (the queries) are read in blocks of bounded size; their terms are the vocabulary of a block. For each
block, two passes go over all documents:

1. every task counts documents with terms, terms, and documents for each term of the vocabulary; Spark adds them up;
2. every task cuts its documents into shards of SHARD_BYTES or less, builds the posting lists of a shard, and ranks all items
   of the block against it by MaxScore: the highest contribution of each list bounds what a term can add, the
   terms whose bounds together stay below the item's threshold are non-essential, documents come from the lists
   of the essential ones alone, and the other lists are probed from the highest bound down while
   the document can still qualify. The threshold is the score at the last place so far in the task, and
   it starts from the ranking of at most SEED_ROWS documents of up to SEED_CHARS characters, which is a bound that the whole table can only raise.

A task hands out at most ``top`` documents an item; Spark merges them in two steps (salted, then by item), so no
group gathers more than the tasks of a salt. A document that ties with the last place counts by its id, so nothing is lost at ties.

Terms are maximal runs of ASCII letters and digits and of characters beyond ASCII; only A to Z are lower-cased. Null
texts have no terms. Items without terms, and items that no document scores for, have no rows; rows with equal item ids are one
item with the terms of all; a null id is an item of its own. Repeated documents are ranked each for itself; null document ids come
last among ties. Texts may have any length; other columns are left alone; empty tables give no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestride.llm.common import _return_memory, few, map_batches, strings

TOP = 50
SHARD_BYTES = 4 << 20
FIRST_SHARD_BYTES = 256 << 10
BLOCK_ITEMS = 4096
BLOCK_BYTES = 8 << 20
SEED_ROWS = 2048
SEED_CHARS = 16_384
SEED_SHARE = 16  # one document in so many may be a seed
MERGE_SALTS = 32

# A term's weight and a document's share of it.
SCALE, UNIT, LENGTH = 1000, 1_000_000_000, 20

# ASCII letters in lower case, digits, and bytes beyond ASCII stay; all else parts terms.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


def terms_of(text: str | None) -> list[bytes]:
    """Terms of a text in order, as UTF-8."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_FOLD).split()


@dataclass
class Block:
    """Items of a block: ids, their terms as numbers, and the vocabulary."""

    ids: list[int | None]
    terms: list[np.ndarray]
    vocabulary: dict[bytes, int]


def item_blocks(items: DataFrame, item_col: str, text_col: str, most_items: int = BLOCK_ITEMS, most_bytes: int = BLOCK_BYTES) -> Iterator[Block]:
    """Items by id, in blocks; one partition at a time comes to the driver."""
    rows = items.select(F.col(f"`{item_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").alias("text")).orderBy(F.asc_nulls_last("id"))
    block, size = Block([], [], {}), 0
    held: set[bytes] = set()

    def add(item: int | None) -> None:
        numbers = sorted(block.vocabulary.setdefault(t, len(block.vocabulary)) for t in held)
        block.ids.append(item)
        block.terms.append(np.array(numbers, np.int64))

    last, any_row = None, False
    for row in rows.toLocalIterator():
        if any_row and row["id"] != last:
            add(last)
            size += sum(map(len, held))
            held = set()
            if len(block.ids) >= most_items or size >= most_bytes:
                yield block
                block, size = Block([], [], {}), 0
        last, any_row = row["id"], True
        held.update(terms_of(row["text"]))
    if any_row:
        add(last)
        yield block


def corpus_counts(rows: DataFrame, vocabulary: dict[bytes, int]) -> tuple[int, int, np.ndarray]:
    """Documents with terms, terms in all, and documents for each term of the vocabulary."""
    shared = rows.sparkSession.sparkContext.broadcast(vocabulary)
    n = len(vocabulary)

    def count(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = np.zeros(n + 2, np.int64)
        known = shared.value
        for text in strings(batch.column("text")):
            words = terms_of(text)
            if words:
                found[n] += 1
                found[n + 1] += len(words)
                have = known.keys() & set(words)
                found[[known[t] for t in have]] += 1
        at = np.flatnonzero(found)
        return pa.RecordBatch.from_arrays([pa.array(at), pa.array(found[at])], names=["term", "n"])

    total = np.zeros(n + 2, np.int64)
    for term, k in map_batches(rows.select("text"), count, "term long, n long").groupBy("term").agg(F.sum("n")).collect():  # the size of the vocabulary
        total[term] = k
    return int(total[n]), int(total[n + 1]), total[:n]


def term_weights(documents: int, df: np.ndarray) -> np.ndarray:
    return np.array([math.floor(SCALE * math.log((2 * documents + 2) / (2 * int(k) + 1))) for k in df], np.int64)


@dataclass
class Shard:
    """Posting lists: of term ``t``, entries start[t] to start[t + 1] of ``doc`` and ``score``, by document."""

    ids: np.ndarray  # of documents
    start: np.ndarray
    doc: np.ndarray
    score: np.ndarray
    bound: np.ndarray  # the highest score of each term


def build_shard(ids: list[int | None], texts: list[list[bytes]], vocabulary: dict[bytes, int], weights: np.ndarray, documents: int, total_terms: int) -> Shard:
    count = len(vocabulary)
    lengths = np.array([len(x) for x in texts], np.int64)
    numbers = np.fromiter((i for words in texts for i in map(vocabulary.get, words, repeat(-1))), np.int64, int(lengths.sum()))
    owner = np.repeat(np.arange(len(texts)), lengths)
    known = numbers >= 0
    cell, tf = np.unique(numbers[known] * len(texts) + owner[known], return_counts=True)
    term, doc = np.divmod(cell, max(len(texts), 1))
    length = 50 + np.array([50 * int(n) * documents // total_terms for n in lengths], np.int64)
    score = weights[term] * ((UNIT * tf) // (SCALE * tf + LENGTH * length[doc]))
    start = np.searchsorted(term, np.arange(count + 1))
    bound = np.zeros(count, np.int64)
    np.maximum.at(bound, term, score)
    # Null ids come after all others.
    return Shard(np.array([np.iinfo(np.int64).max if i is None else i for i in ids], np.int64), start, doc, score, bound)


class Ranking:
    """The best documents of an item so far, best first, and the score that a further one must reach."""

    def __init__(self, top: int, threshold: int = 1) -> None:
        self.top, self.threshold = top, threshold
        self.score, self.id = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def add(self, score: np.ndarray, ids: np.ndarray) -> None:
        keep = score >= self.threshold
        score, ids = np.concatenate([self.score, score[keep]]), np.concatenate([self.id, ids[keep]])
        order = np.lexsort((ids, -score))[: self.top]
        self.score, self.id = score[order], ids[order]
        if len(order) == self.top:
            self.threshold = max(self.threshold, int(self.score[-1]))


def max_score(shard: Shard, terms: np.ndarray, ranking: Ranking) -> None:
    """Adds to ``ranking`` the documents of a shard that reach its threshold."""
    bounds = shard.bound[terms]
    terms, bounds = terms[bounds > 0], bounds[bounds > 0]
    order = np.argsort(bounds, kind="stable")
    terms, reach = terms[order], np.cumsum(bounds[order])  # reach[i]: what terms 0 to i can add together
    essential = int(np.searchsorted(reach, ranking.threshold, "left"))  # the first whose reach gets to the threshold
    if essential == len(terms):
        return
    total = np.zeros(len(shard.ids), np.int64)
    for t in terms[essential:]:
        at = slice(shard.start[t], shard.start[t + 1])
        total[shard.doc[at]] += shard.score[at]  # a document is once in a list
    found = np.flatnonzero(total)
    score = total[found]
    for i in range(essential - 1, -1, -1):
        able = score + reach[i] >= ranking.threshold
        found, score = found[able], score[able]
        if not len(found):
            return
        docs, scores = shard.doc[shard.start[terms[i]] : shard.start[terms[i] + 1]], shard.score[shard.start[terms[i]] : shard.start[terms[i] + 1]]
        at = np.minimum(np.searchsorted(docs, found), len(docs) - 1)
        score = score + np.where(docs[at] == found, scores[at], 0)
    ranking.add(score, shard.ids[found])


def _ranked(rows: DataFrame, block: Block, weights: np.ndarray, documents: int, total_terms: int, top: int, thresholds: list[int], shard_bytes: int) -> DataFrame:
    """The best documents of each task for each item: item (its number), doc_id, score."""
    shared = rows.sparkSession.sparkContext.broadcast((block.vocabulary, block.terms, weights, thresholds))

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, items, w, least = shared.value
        rankings = [Ranking(top, t) for t in least]
        ids, texts, size, limit = [], [], 0, min(FIRST_SHARD_BYTES, shard_bytes)

        def rank() -> None:
            shard = build_shard(ids, texts, vocabulary, w, documents, total_terms)
            for terms, ranking in zip(items, rankings):
                max_score(shard, terms, ranking)

        for batch in batches:
            for i, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                words = terms_of(text.as_py())
                if not words:
                    continue
                ids.append(i)
                texts.append(words)
                size += len(text.as_py())
                if size >= limit:
                    rank()
                    ids, texts, size, limit = [], [], 0, shard_bytes
        if texts:
            rank()
        lengths = [len(r.id) for r in rankings]
        best = np.concatenate([r.id for r in rankings]) if rankings else np.zeros(0, np.int64)
        score = np.concatenate([r.score for r in rankings]) if rankings else np.zeros(0, np.int64)
        none = best == np.iinfo(np.int64).max
        del rankings, ids, texts
        yield pa.RecordBatch.from_arrays([pa.array(np.repeat(np.arange(len(lengths)), lengths)), pa.array(best, mask=none), pa.array(score)], names=["item", "doc_id", "score"])
        _return_memory()

    return rows.mapInArrow(over, "item long, doc_id long, score long")


def _merged(found: DataFrame, top: int) -> DataFrame:
    """The best ``top`` of each item with their ranks."""
    best = lambda keys: F.expr(f"row_number() OVER (PARTITION BY {keys} ORDER BY score DESC, doc_id ASC NULLS LAST)")
    salted = found.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(MERGE_SALTS)).cast("int")).withColumn("rank", best("item, salt")).where(F.col("rank") <= top)
    return salted.withColumn("rank", best("item")).where(F.col("rank") <= top).drop("salt")


def rank_documents(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
    top: int = TOP, most_items: int = BLOCK_ITEMS, shard_bytes: int = SHARD_BYTES, seed_rows: int = SEED_ROWS,
) -> DataFrame:
    """The ``top`` documents of each item: item_id, rank, doc_id, score."""
    spark = docs.sparkSession
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    out = spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    some = (F.pmod(F.xxhash64("text", F.lit(7)), F.lit(SEED_SHARE)) == 0) & (F.length("text") <= SEED_CHARS)
    seeds = few(rows.where(some), seed_rows) if seed_rows else None
    for block in item_blocks(items, item_col, item_text_col, most_items):
        if not block.vocabulary:
            continue
        documents, total_terms, df = corpus_counts(rows, block.vocabulary)
        if not documents:
            continue
        weights = term_weights(documents, df)
        thresholds = [1] * len(block.ids)
        if seeds is not None:
            first = _merged(_ranked(seeds, block, weights, documents, total_terms, top, thresholds, shard_bytes), top)
            for item, score in first.where(F.col("rank") == top).select("item", "score").collect():  # one row an item of the block
                thresholds[item] = score
        best = _merged(_ranked(rows, block, weights, documents, total_terms, top, thresholds, shard_bytes), top)
        names = spark.createDataFrame(list(enumerate(block.ids)), "item long, item_id long")
        best = best.join(F.broadcast(names), "item")  # at most most_items rows
        out = out.unionByName(best.select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score"))
    return out


SQL = r"""WITH fold AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms, row_number() OVER () AS r FROM documents),
    size AS (SELECT r, doc_id, len(terms) AS n, sum(len(terms)) OVER () AS l, count(*) OVER () AS big FROM fold WHERE len(terms) > 0),
    m AS (SELECT r, doc_id, big, 50 + CAST(50 * n * big AS BIGINT) // CAST(l AS BIGINT) AS m FROM size),
    tf AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(terms) AS term FROM fold) GROUP BY ALL),
    w AS (SELECT term, CAST(floor(1000 * ln(CAST(2 * (SELECT max(big) FROM m) + 2 AS DOUBLE) / (2 * count(*) + 1))) AS BIGINT) AS w FROM tf GROUP BY term),
    asked AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
    scored AS (SELECT item_id, r, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m))) AS BIGINT) AS score FROM asked JOIN w USING (term) JOIN tf USING (term) JOIN m USING (r) GROUP BY ALL),
    placed AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scored WHERE score > 0)
    SELECT item_id, CAST(rank AS INT) AS rank, doc_id, score FROM placed WHERE rank <= 50"""
