"""Codes and codebooks against plain loops over every entry."""

import hashlib
import math
import random

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lodestride.llm import vector_codes as vc

SCHEMA = "vec_id long, embedding array<float>, label int"


def plain(rows):
    kept = [(i, label, [math.floor(4096 * x) for x in np.float32(v).tolist()]) for i, v, label in rows if v and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0], r[2]))
    d = len(kept[0][2]) // 8
    parts = [[r[2][p * d : (p + 1) * d] for p in range(8)] for r in kept]
    books = [[x[p] for x in parts[:16]] for p in range(8)]

    def nearest(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, c)), e) for e, c in enumerate(book))

    for _ in range(6):
        for p in range(8):
            of = {}
            for x in parts:
                of.setdefault(nearest(x[p], books[p])[1], []).append(x[p])
            books[p] = [[sum(c) // len(of[e]) for c in zip(*of[e])] if e in of else c for e, c in enumerate(books[p])]
    digest = hashlib.sha256(",".join(str(n) for b in books for c in b for n in c).encode()).hexdigest()
    found = [[nearest(x[p], books[p]) for p in range(8)] for x in parts]
    errors = [sum(d for d, _ in f) for f in found]
    total = {}
    for (_, label, _), e in zip(kept, errors):
        total[label] = total.get(label, 0) + e
    return sorted((r[0], "".join(f"{e:02x}" for _, e in f), err, total[r[1]], digest) for r, f, err in zip(kept, found, errors))


def table(n, width=16, seed=3):
    rng = random.Random(seed)
    rows = [(i * 3, [rng.gauss(0, 1 + i % 3) for _ in range(width)], rng.choice([1, 2, None])) for i in range(n)]
    rows += [(r[0], r[1], r[2]) for r in rows[:5]]  # repeated rows
    rows += [(n * 3 + i, [0.25] * width, 7) for i in range(10)]  # ties
    return [*rows, (1, None, 1), (2, [], 1), (4, [None, *[1.0] * (width - 1)], 1), (5, [math.nan] * width, 1), (7, [math.inf] * width, 2)]


def result(df):
    return sorted(tuple(r) for r in df.select("vec_id", "code", "error", "label_error", "codebooks_sha256").collect())


@pytest.mark.parametrize("n", [6, 150])
def test_codes_by_plain_loops(spark, n):
    rows = table(n)
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert result(vc.compress(df)) == plain(rows)


def test_sql_and_long_lists_of_labels(spark):
    rows = table(80)
    con = duckdb.connect()
    con.execute("CREATE TABLE embeddings (vec_id BIGINT, embedding FLOAT[], label INT)")
    con.executemany("INSERT INTO embeddings VALUES (?, ?, ?)", rows)
    want = plain(rows)
    assert sorted(con.execute(vc.SQL).fetchall()) == want
    assert result(vc.compress(spark.createDataFrame(rows, SCHEMA), max_labels=1)) == want


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 16), st.integers(1, 4), st.integers(1, 300), st.integers(0, 10**6))
def test_annulus_loses_no_entry(entries, width, spread, seed):
    rng = np.random.default_rng(seed)
    book, x = rng.integers(-spread, spread + 1, (entries, width)), rng.integers(-spread, spread + 1, (40, width))
    index, best = vc.nearest_entries(x, book)
    every = ((x[:, None] - book[None]) ** 2).sum(2)
    assert (index == every.argmin(1)).all() and (best == every.min(1)).all()



def test_annulus_at_the_largest_values():
    x = np.array([[vc.LARGEST] * 8, [-vc.LARGEST] * 8, [0] * 8])
    index, best = vc.nearest_entries(x, x[::-1].copy())
    assert index.tolist() == [2, 1, 0] and (best == 0).all()


def test_empty_and_clashing_columns(spark):
    assert vc.compress(spark.createDataFrame([], SCHEMA)).collect() == []
    assert vc.compress(spark.createDataFrame([(1, None, 2)], SCHEMA)).collect() == []
    rows = table(20)
    wide = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS vector", "2 AS code", "3 AS error", "4 AS cell", "5 AS of")
    assert result(vc.compress(wide)) == plain(rows)


def test_too_large_components_are_refused(spark):
    with pytest.raises(Exception, match="can't be compressed"):
        vc.compress(spark.createDataFrame([(1, [1e30] * 8, 1)], SCHEMA))
