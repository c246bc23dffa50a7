"""Vector code compression: product codes whose nearest entries are found by annular norm pruning.

Vectors become integers, floor(4096 x), and are cut in PARTS consecutive parts; each part position has a
codebook of up to ENTRIES entries. An entry is looked for in the entries sorted by norm: the one with the nearest
norm gives a first distance, a binary search the interval of norms within that distance of the part's own norm (by
the triangle inequality no other entry can be as near), and the entries of this annulus alone, both ends included,
are evaluated in exact integers, the annulus shrinking with the best distance. Ties go to the lower index.

Fitting is exact and covers every row: a round is one pass in which tasks hand out sums for each entry, which Spark
adds up; the driver holds the codebooks alone (PARTS x ENTRIES entries). The table is read once a round
and once for the codes, so nothing but the result is stored, and a lost executor costs its tasks only.

Rows whose vector is null, empty or holds null or non-finite components are dropped, and so are rows whose length
isn't that of the kept row with the smallest id, or no multiple of PARTS. Repeated rows count each for itself; rows with equal ids
start codebooks in the order of their vectors, null ids last. With fewer than ENTRIES rows there are as many entries as rows,
and an empty table gives no rows. Components beyond 32,768 in size are an error, as their squares leave 64 bits. Other columns are left alone.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestride.llm.common import checkpointed, map_batches

PARTS = 8
ENTRIES = 16
ROUNDS = 6
SCALE = 4096
LARGEST = 1 << 27

MAX_LABELS = 65_536  # a longer list of labels is joined by shuffle
SPREAD = 64


def nearest_entries(x: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of the nearest row of ``book`` for each row of ``x`` (int64), and its squared distance."""
    norms = np.sqrt((book * book).sum(1).astype(float))
    order = np.argsort(norms, kind="stable")
    sorted_norms, own = norms[order], np.sqrt((x * x).sum(1).astype(float))

    def distance(rows: np.ndarray, at: np.ndarray) -> np.ndarray:
        gap = x[rows] - book[order[at]]
        return (gap * gap).sum(1)

    # The slack covers rounding of square roots; it only ever adds entries.
    slack = 1e-5 + 1e-12 * (own + sorted_norms[-1])
    right = np.clip(np.searchsorted(sorted_norms, own), 1, max(len(order) - 1, 1))
    first = np.where(np.abs(sorted_norms[right - 1] - own) <= np.abs(sorted_norms[np.minimum(right, len(order) - 1)] - own), right - 1, np.minimum(right, len(order) - 1))
    best = distance(np.arange(len(x)), first)
    index = order[first]
    radius = np.sqrt(best.astype(float)) + slack
    low, high = np.searchsorted(sorted_norms, own - radius, "left"), np.searchsorted(sorted_norms, own + radius, "right")
    for step in range(int((high - low).max(initial=0))):
        at = low + step
        rows = np.flatnonzero((at < high) & (at != first))
        rows = rows[np.abs(sorted_norms[at[rows]] - own[rows]) <= np.sqrt(best[rows].astype(float)) + slack[rows]]
        if len(rows):
            d, entry = distance(rows, at[rows]), order[at[rows]]
            better = (d < best[rows]) | ((d == best[rows]) & (entry < index[rows]))
            rows = rows[better]
            best[rows], index[rows] = d[better], entry[better]
    return index, best


def _parts(vectors: pa.Array) -> np.ndarray:
    """Integers of a batch, by row, part and position."""
    flat = np.floor(SCALE * vectors.flatten().to_numpy(zero_copy_only=False).astype(float))
    if np.abs(flat).max(initial=0) > LARGEST:
        raise ValueError(f"components beyond {LARGEST // SCALE} can't be compressed exactly")
    return flat.astype(np.int64).reshape(len(vectors), PARTS, -1)


def _usable(vector: Column) -> Column:
    return vector.isNotNull() & (F.size(vector) > 0) & (F.size(vector) % PARTS == 0) & ~F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))


def fit_codebooks(rows: DataFrame, start: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """Codebooks (part, entry, position) after ``rounds`` rounds over the column ``vector`` of ``rows``."""
    books = start
    for _ in range(rounds):

        def sums(batch: pa.RecordBatch, books: np.ndarray = books) -> pa.RecordBatch:
            x, total = _parts(batch.column("vector")), np.zeros((*books.shape[:2], books.shape[2] + 1), np.int64)
            for p, book in enumerate(books):
                index, _ = nearest_entries(x[:, p], book)
                np.add.at(total[p], index, np.pad(x[:, p], ((0, 0), (0, 1)), constant_values=1))  # the last column counts
            return pa.RecordBatch.from_arrays([pa.array(np.arange(total.size)), pa.array(total.ravel())], names=["cell", "total"])

        found = map_batches(rows, sums, "cell long, total long").groupBy("cell").agg(F.sum("total").alias("total")).collect()  # the size of the codebooks
        total = np.zeros((*books.shape[:2], books.shape[2] + 1), np.int64)
        for cell, n in found:
            total.flat[cell] = n
        count = total[..., -1:]
        books = np.where(count > 0, np.floor_divide(total[..., :-1], np.maximum(count, 1)), books)
    return books


def _with_label_error(codes: DataFrame, max_labels: int) -> DataFrame:
    """``codes`` with the error summed over equal labels, nulls together."""
    sums = checkpointed(codes.groupBy("label").agg(F.sum("error").alias("label_error")).withColumnRenamed("label", "of"))
    same = F.col("label").eqNullSafe(F.col("of"))
    if sums.count() <= max_labels:
        return codes.join(F.broadcast(sums), same)
    # A label may hold a third of all rows: its rows are spread over as many keys as its sum.
    spread = sums.withColumn("at", F.explode(F.sequence(F.lit(0), F.lit(SPREAD - 1))))
    return codes.withColumn("salt", F.pmod(F.xxhash64("vec_id", "code"), F.lit(SPREAD)).cast("int")).join(spread, same & (F.col("salt") == F.col("at")))


def compress(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", rounds: int = ROUNDS, max_labels: int = MAX_LABELS) -> DataFrame:
    """One row per kept vector: vec_id, label, code, error, label_error, codebooks_sha256."""
    vector = F.col(f"`{vector_col}`")
    rows = vectors.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), F.col(f"`{label_col}`").alias("label"), vector.cast("array<double>").alias("vector")).where(_usable(F.col("vector")))
    schema = f"vec_id long, label {rows.schema['label'].dataType.simpleString()}, code string, error long"
    width = F.size("vector")
    head = rows.orderBy(F.asc_nulls_last("vec_id"), "vector").select(width.alias("n")).head()
    if head is None:
        empty = rows.sparkSession.createDataFrame([], schema)
        return empty.withColumns({"label_error": F.lit(0).cast("long"), "codebooks_sha256": F.lit("")})
    rows = rows.where(width == head["n"])
    first = [r["vector"] for r in rows.orderBy(F.asc_nulls_last("vec_id"), "vector").limit(ENTRIES).collect()]
    start = _parts(pa.array(first, pa.list_(pa.float64()))).transpose(1, 0, 2)
    books = fit_codebooks(rows.select("vector"), start, rounds)

    def encode(batch: pa.RecordBatch) -> pa.RecordBatch:
        x = _parts(batch.column("vector"))
        found = [nearest_entries(x[:, p], book) for p, book in enumerate(books)]
        digits = np.stack([i for i, _ in found], 1).astype(np.uint8)
        code = [bytes(r).hex() for r in digits]
        error = sum(d for _, d in found)
        return pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("label"), pa.array(code, pa.string()), pa.array(error, pa.int64())], names=["vec_id", "label", "code", "error"])

    codes = _with_label_error(map_batches(rows, encode, schema), max_labels)
    digest = hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()
    return codes.select("vec_id", "label", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))


def _sql() -> str:
    """The result of compress without ``label``, as DuckDB SQL."""
    finite = "embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0"
    ctes = [
        f"v AS MATERIALIZED (SELECT vec_id, label, row_number() OVER (ORDER BY vec_id, embedding) - 1 AS r, list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings WHERE {finite})",
        f"parts AS MATERIALIZED (SELECT r, p, v[p * (len(v) // {PARTS}) + 1 : (p + 1) * (len(v) // {PARTS})] AS x FROM v, range({PARTS}) t(p))",
        f"b0 AS MATERIALIZED (SELECT p, r AS e, x AS c FROM parts WHERE r < {ENTRIES})",
    ]
    for n in range(ROUNDS + 1):
        ctes.append(f"""a{n} AS MATERIALIZED (SELECT r, p, any_value(x) AS x, min(struct_pack(d := list_sum(list_transform(range(1, len(x) + 1), lambda i: (x[i] - c[i]) * (x[i] - c[i]))), e := e)) AS best
          FROM parts JOIN b{n} USING (p) GROUP BY r, p)""")
        if n < ROUNDS:
            ctes.append(f"""u{n} AS (SELECT p, e, list(m ORDER BY i) AS c FROM (SELECT p, best.e AS e, i, CAST(floor(CAST(sum(x[i]) AS DOUBLE) / count(*)) AS BIGINT) AS m
              FROM a{n}, range(1, 1 + (SELECT max(len(x)) FROM parts)) t(i) GROUP BY 1, 2, 3) GROUP BY 1, 2),
            b{n + 1} AS MATERIALIZED (SELECT p, e, coalesce(u{n}.c, b{n}.c) AS c FROM b{n} LEFT JOIN u{n} USING (p, e))""")
    return f"""WITH {", ".join(ctes)},
    coded AS (SELECT r, string_agg(printf('%02x', best.e), '' ORDER BY p) AS code, CAST(sum(best.d) AS BIGINT) AS error FROM a{ROUNDS} GROUP BY r),
    digest AS (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, e)) AS s FROM b{ROUNDS})
    SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, (SELECT s FROM digest) AS codebooks_sha256 FROM v JOIN coded USING (r)"""


SQL = _sql()
