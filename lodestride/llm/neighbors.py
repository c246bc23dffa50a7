"""Nearest neighbours by adaptive dimension scan over inverted lists.

Equal vectors are searched once: a class is a distinct vector with its k + 1 smallest ids, which
are all that a result can hold. Vectors are rotated by a fixed random orthogonal matrix, so that
a prefix of dimensions is a random projection, and dealt to the nearest of some centroids. A list
is scanned column block by column block: after d of D dimensions, a candidate whose partial
distance p fails the test p x D / d <= (1 + EPSILON / sqrt(d))^2 x (k-th distance so far) is
dropped. Survivors get their exact Euclidean distance in double precision from the original
vectors, and only these distances rank results.

There are about 2 sqrt(n) lists, so a list's rows grow with the square root of the table. A list has a pair of
centroids: one of the vectors, and one of what is left after that one is taken off; both codebooks have about the fourth
root of n entries and are fitted on a bounded sample (``SAMPLE`` classes by hash), as is the number of lists to probe: as many as
reach ``TARGET_RECALL`` for sampled queries among sampled rows. Every row is indexed. The sample also gives each
query a bound of the distances to keep at the start.

Work units are (list, row chunk, query chunk) with bounded rows and queries, so a list that holds
very many rows, or is probed by very many queries, spreads over tasks.

Vectors that are null, zero, hold a null or non-finite component, or have another number of
components than most take no part, nor do rows with a null id. Repeated rows (same id and vector) count
once; of an id with several vectors each is a row. Fewer than k candidates give fewer results.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lodestride.llm.common import checkpointed

SAMPLE = 8192
CALIBRATION_QUERIES = 200
TARGET_RECALL = 0.985
LISTS = 2.0  # times the square root of the number of vectors
CHUNK_ROWS = 8192
CHUNK_QUERIES = 2048
COLUMN_BLOCK = 16
EPSILON = 2.1
FIRST_ROWS = 64


@lru_cache(4)
def rotation(dims: int, seed: int = 0) -> np.ndarray:
    """Random orthogonal matrix, the same in every task."""
    q, r = np.linalg.qr(np.random.default_rng(seed).normal(size=(dims, dims)))
    return q * np.sign(np.diag(r))


def _matrix(column) -> np.ndarray:
    """Vectors of a list column, rows x dims."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1).astype(np.float64) if len(column) else np.zeros((0, 1))


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.maximum((a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2 * a @ b.T, 0)


def kmeans(x: np.ndarray, k: int, rounds: int = 8) -> np.ndarray:
    centers = x[np.random.default_rng(1).permutation(len(x))[:k]].copy()
    for _ in range(rounds):
        home = squared(x, centers).argmin(1)
        n = np.bincount(home, minlength=len(centers))
        sums = np.stack([np.bincount(home, x[:, d], len(centers)) for d in range(x.shape[1])], 1)
        centers[n > 0] = sums[n > 0] / n[n > 0, None]
    return centers


@dataclass
class Lists:
    """Centroids of all lists: sums of one entry of each codebook."""

    coarse: np.ndarray
    fine: np.ndarray

    @staticmethod
    def fitted(x: np.ndarray, lists: int) -> Lists:
        first = max(1, round(lists**0.5))
        coarse = kmeans(x, min(first, len(x)))
        left = x - coarse[squared(x, coarse).argmin(1)]
        return Lists(coarse, kmeans(left, min(-(-lists // first), len(x))) if lists > first else np.zeros((1, x.shape[1])))

    def __len__(self) -> int:
        return len(self.coarse) * len(self.fine)

    def distances(self, x: np.ndarray) -> np.ndarray:
        """Squared distances to all lists' centroids, from products with each codebook."""
        cross = (self.coarse @ self.fine.T).ravel()
        norms = ((self.coarse**2).sum(1)[:, None] + (self.fine**2).sum(1)[None, :]).ravel() + 2 * cross
        near = (x @ self.coarse.T)[:, :, None] + (x @ self.fine.T)[:, None, :]
        return np.maximum((x * x).sum(1)[:, None] + norms[None, :] - 2 * near.reshape(len(x), -1), 0)

    def homes(self, x: np.ndarray) -> np.ndarray:
        step = max(1, (1 << 21) // max(1, len(self)))  # bounds the matrix of distances
        return np.concatenate([np.empty(0, np.int64), *(self.distances(x[i : i + step]).argmin(1) for i in range(0, len(x), step))])


def probes_needed(x: np.ndarray, lists: Lists, home: np.ndarray, k: int, target: float) -> int:
    """Lists to probe so that sampled queries find ``target`` of their true neighbours in the sample."""
    q = x[:: max(1, len(x) // CALIBRATION_QUERIES)]
    near = np.argsort(squared(q, x), 1, kind="stable")[:, 1 : k + 1]
    away = lists.distances(q)
    places = np.sort((away[:, None, :] < np.take_along_axis(away, home[near], 1)[:, :, None]).sum(2).ravel())
    return int(places[min(len(places) - 1, int(np.ceil(target * len(places))) - 1)]) + 1 if len(places) else 1


def scan(rotated: np.ndarray, queries: np.ndarray, k: int, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(query, row) pairs, by query, that may be among the k nearest rows to a query, by the adaptive test; ``bounds``: known k-th distances, squared.

    Column block by column block, for all queries at once: the first block of all pairs is one matrix product, later ones are
    added to the pairs that are left. The first rows are scanned before the others, to bound these.
    """
    dims, bounds = rotated.shape[1], bounds.copy()
    found_q, found_r = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    for start, end in ((0, FIRST_ROWS), (FIRST_ROWS, len(rotated))):
        rows = rotated[start:end]
        if not len(rows):
            continue
        partial = squared(queries[:, :COLUMN_BLOCK], rows[:, :COLUMN_BLOCK])
        seen = min(dims, COLUMN_BLOCK)

        def slack(seen: int) -> float:
            return (1 + EPSILON / np.sqrt(seen)) ** 2 if seen < dims else 1 + 1e-9

        q, r = np.nonzero(partial * (dims / seen) <= slack(seen) * bounds[:, None] + 1e-12)
        partial = partial[q, r]
        for d in range(COLUMN_BLOCK, dims, COLUMN_BLOCK):
            block = rows[r, d : d + COLUMN_BLOCK] - queries[q, d : d + COLUMN_BLOCK]
            partial += np.einsum("ij,ij->i", block, block)
            seen = min(dims, d + COLUMN_BLOCK)
            keep = partial * (dims / seen) <= slack(seen) * bounds[q] + 1e-12
            q, r, partial = q[keep], r[keep], partial[keep]
        # The k-th of a query's rows bounds what follows.
        order = np.lexsort((partial, q))
        first = np.searchsorted(q[order], np.arange(len(queries)))
        last = first + k - 1
        full = np.flatnonzero(last < np.searchsorted(q[order], np.arange(len(queries)), side="right"))
        bounds[full] = np.minimum(bounds[full], partial[order][last[full]] * (1 + 1e-9))
        found_q.append(q)
        found_r.append(r + start)
    q, r = np.concatenate(found_q), np.concatenate(found_r)
    order = np.argsort(q, kind="stable")
    return q[order], r[order]


def search_unit(vectors: np.ndarray, ids: list[list[int]], queries: np.ndarray, bounds: np.ndarray, k: int) -> list[tuple[int, int, float]]:
    """(query row, id, distance) of the k nearest ids to each query, ties to smaller ids."""
    turn = rotation(vectors.shape[1])
    rotated, turned, out = vectors @ turn, queries @ turn, []
    step = max(1, (1 << 20) // max(1, len(vectors)))  # queries at a time
    for at in range(0, len(queries), step):
        q, r = scan(rotated, turned[at : at + step], k, bounds[at : at + step] * (1 + 1e-9))
        diff = vectors[r] - queries[at + q]
        exact = np.sqrt(np.einsum("ij,ij->i", diff, diff))
        order = np.lexsort((exact, q))
        q, r, exact = q[order], r[order], exact[order]
        cuts = np.searchsorted(q, np.arange(min(step, len(queries) - at) + 1))
        for i, (low, high) in enumerate(zip(cuts[:-1], cuts[1:])):
            if high - low > k:  # rows as far as the k-th are ties
                high = low + int(np.searchsorted(exact[low:high], exact[low + k - 1], side="right"))
            best = sorted((d, x) for d, row in zip(exact[low:high].tolist(), r[low:high].tolist()) for x in ids[row])[:k]
            out += [(at + i, x, d) for d, x in best]
    return out


def nearest(table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", every: int = 100, k: int = 10, sample: int = SAMPLE, target_recall: float = TARGET_RECALL) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest rows to each row whose id is divisible by ``every``."""
    rows = table.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v")).where(
        "vec_id is not null and v is not null and size(v) > 0 and exists(v, x -> x != 0)"
        " and forall(v, x -> x is not null and not isnan(x) and abs(x) < double('infinity'))"
    )
    sizes = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    if sizes is None:
        return table.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    rows = rows.where(F.size("v") == sizes.n)
    # Classes of equal vectors: the window keeps k + 1 ids of each before the shuffle, too.
    first = Window.partitionBy("v").orderBy("vec_id")
    few = rows.select("v", "vec_id").withColumn("r", F.dense_rank().over(first)).where(F.col("r") <= k + 1)
    classes = few.groupBy("v").agg(F.sort_array(F.collect_set("vec_id")).alias("ids"))
    classes = checkpointed(classes.withColumn("class", F.element_at("ids", 1)).select("class", "v", "ids"))
    total = classes.count()
    drawn = classes.orderBy(F.xxhash64("class"), "class").limit(sample).select("v").toArrow()
    x = _matrix(drawn.column("v"))
    lists = Lists.fitted(x, max(1, round(LISTS * total**0.5)))
    known_homes = lists.homes(x)
    probe = probes_needed(x, lists, known_homes, k, target_recall)
    shared = table.sparkSession.sparkContext.broadcast((lists, x, known_homes))

    def assign(batches):
        for b in batches:
            v = _matrix(b.column("v"))
            home = shared.value[0].homes(v) if len(v) else np.empty(0, np.int64)
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in ("class", "v", "ids")), pa.array(home, pa.int32())], names=["class", "v", "ids", "list"])

    homed = checkpointed(classes.mapInArrow(assign, "class long, v array<double>, ids array<long>, list int"))

    # Distinct query vectors, with the lists to probe and a first bound of the (k + 1)-th distance.
    asked = rows.where(F.col("vec_id") % every == 0).select(F.col("vec_id").alias("query_id"), "v").distinct()
    asked = checkpointed(asked.join(classes.select("v", "class"), "v").select("query_id", "class"))
    units = classes.join(asked.select("class").distinct(), "class").select("class", "v")

    def route(batches):
        lists, known, homes = shared.value
        far = min(3 * (k + 1), len(known) - 1)
        for b in batches:
            v = _matrix(b.column("v"))
            if not len(v):
                continue
            # Lists that hold a query's nearest sampled rows are probed, too. The bound is of a rank
            # beyond k, so that the test's few wrong drops can't leave fewer than k results.
            distance, lists_of = [], []
            for i in range(0, len(v), 128):
                part = v[i : i + 128]
                away, near = lists.distances(part), squared(part, known)
                order = np.argpartition(away, probe - 1, 1)[:, :probe] if probe < away.shape[1] else np.tile(np.arange(away.shape[1]), (len(part), 1))
                rows = np.argpartition(near, far, 1)[:, : far + 1]
                distance.append(np.take_along_axis(near, rows, 1).max(1) if far > k else np.full(len(part), np.inf))
                lists_of += [np.union1d(a, homes[r]).astype(np.int32) for a, r in zip(order, rows)]
            columns = [b.column("class"), b.column("v"), pa.array(np.concatenate(distance)), pa.array(lists_of, pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays(columns, names=["class", "v", "bound", "lists"])

    routed = checkpointed(units.mapInArrow(route, "class long, v array<double>, bound double, lists array<int>"))
    routed = routed.select("class", "v", "bound", F.explode("lists").alias("list"))

    # Chunks of each list, as many as its rows and its queries need: a small table, a row a list.
    def chunks(rows: DataFrame, size: int, name: str) -> DataFrame:
        return rows.groupBy("list").agg(F.ceil(F.count(F.lit(1)) / size).cast("int").alias(name))

    plan = checkpointed(chunks(homed, CHUNK_ROWS, "rcs").join(chunks(routed, CHUNK_QUERIES, "qcs"), "list"))
    own = F.xxhash64("class")
    left = homed.join(plan, "list").withColumn("rc", F.pmod(own, "rcs").cast("int")).withColumn("qc", F.explode(F.sequence(F.lit(0), F.col("qcs") - 1)))
    right = routed.join(plan, "list").withColumn("qc", F.pmod(own, "qcs").cast("int")).withColumn("rc", F.explode(F.sequence(F.lit(0), F.col("rcs") - 1)))

    def unit(rows: pa.Table, asks: pa.Table) -> pa.Table:
        out = []
        if rows.num_rows and asks.num_rows:
            who = asks.column("class").to_pylist()
            bounds = asks.column("bound").to_numpy()
            found = search_unit(_matrix(rows.column("v")), rows.column("ids").to_pylist(), _matrix(asks.column("v")), bounds, k + 1)
            out = [(who[q], i, d) for q, i, d in found]
        columns = list(zip(*out)) if out else [(), (), ()]
        kinds = [pa.int64(), pa.int64(), pa.float64()]
        return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=["class", "vec_id", "score"])

    found = left.groupBy("list", "rc", "qc").cogroup(right.groupBy("list", "rc", "qc")).applyInArrow(unit, "class long, vec_id long, score double")
    order = Window.partitionBy("class").orderBy("score", "vec_id")
    best = found.distinct().withColumn("r", F.row_number().over(order)).where(F.col("r") <= k + 1).drop("r")
    answers = asked.join(best, "class").where("vec_id != query_id")
    final = Window.partitionBy("query_id").orderBy("score", "vec_id")
    ranked = answers.select("query_id", F.row_number().over(final).alias("rank"), "vec_id", "score")
    return ranked.where(F.col("rank") <= k)
