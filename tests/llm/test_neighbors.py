import math
import random

import numpy as np
import pyarrow as pa

from lodestride.llm import neighbors as S


def brute(rows, every, k):
    good = sorted({(i, tuple(v)) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v) and len(v) == 8})
    out = {}
    for i, q in good:
        if i % every == 0:
            found = sorted((math.dist(q, v), j) for j, v in good if j != i)[:k]
            out.setdefault(i, []).extend(found)
    return out


def test_small_and_odd_tables(spark):
    rng = random.Random(0)
    rows = [(i, [rng.gauss(0, 1) for _ in range(8)]) for i in range(120)]
    rows += [(i, rows[3][1]) for i in range(200, 260)]  # copies, some of them queries
    rows += [(300, None), (310, [0.0] * 8), (320, [1.0] * 7 + [None]), (330, [float("nan")] * 8), (340, [1.0] * 3), (None, [1.0] * 8)]
    rows += [rows[10], rows[10]]
    docs = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("vec_id", "embedding", "1 as score", "2 as class").repartition(4)
    got = {}
    for r in sorted(S.nearest(docs, every=10, target_recall=1.0).collect(), key=lambda r: (r.query_id, r.rank)):
        got.setdefault(r.query_id, []).append((r.score, r.vec_id))
    want = brute(rows, 10, 10)
    assert set(got) == set(want)
    assert np.mean([[j for _, j in got[i]] == [j for _, j in want[i]] for i in want]) > 0.95
    assert all(np.allclose([d for d, _ in got[i]], [d for d, _ in want[i]]) for i in want if [j for _, j in got[i]] == [j for _, j in want[i]])
    assert got[200] == [(0.0, j) for j in (3, *range(201, 210))]
    assert len(S.nearest(docs.where("vec_id in (10, 20)"), every=10).collect()) == 2
    assert S.nearest(docs.limit(0)).count() == 0


def test_adaptive_scan_drops_rows_but_not_neighbours():
    rng = np.random.default_rng(0)
    x, q = rng.normal(size=(4000, 64)), rng.normal(size=(20, 64))
    turn, kept, hit = S.rotation(64), 0, 0
    assert np.allclose(turn @ turn.T, np.eye(64))
    for v in q:
        _, rows = S.scan(x @ turn, (v @ turn)[None], 10, np.array([np.inf]))
        true = np.argsort(((x - v) ** 2).sum(1))[:10]
        kept += len(rows)
        hit += len(np.intersect1d(rows, true))
    assert hit >= 0.99 * 200 and kept < 0.2 * 80_000


def test_recall_on_embeddings(spark):
    table = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    t = table.toPandas().sort_values("vec_id")
    x, ids = np.array(t["embedding"].tolist(), np.float64), t["vec_id"].to_numpy()
    got = S.nearest(table).toPandas()
    hit = 0
    queries = [i for i in ids if i % 100 == 0]
    for i in queries:
        d = np.sqrt(((x - x[np.flatnonzero(ids == i)[0]]) ** 2).sum(1))
        d[ids == i] = np.inf
        mine = got[got.query_id == i].sort_values("rank")
        assert len(mine) == 10 and (np.diff(mine.score) >= 0).all()
        hit += len(set(mine.vec_id) & set(ids[np.lexsort((ids, d))[:10]]))
    assert hit / (10 * len(queries)) >= 0.95


def test_lists_are_sums_of_two_codebooks():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(500, 6))
    lists = S.Lists.fitted(x, 50)
    centers = (lists.coarse[:, None, :] + lists.fine[None, :, :]).reshape(-1, 6)
    assert 45 <= len(lists) <= 60 and np.allclose(lists.distances(x), S.squared(x, centers))
    assert (lists.homes(x) == S.squared(x, centers).argmin(1)).all()


def test_scan_of_many_queries_equals_one_by_one():
    rng = np.random.default_rng(3)
    x, q = rng.normal(size=(700, 40)), rng.normal(size=(30, 40))
    bounds = np.full(30, np.inf)
    many = S.scan(x, q, 5, bounds)
    for i in range(30):
        assert set(many[1][many[0] == i]) == set(S.scan(x, q[i : i + 1], 5, bounds[:1])[1])


def test_recall_at_several_sizes(spark):
    rng = np.random.default_rng(1)
    centers = rng.normal(size=(60, 24))
    for n in (2_000, 30_000):
        x = centers[rng.integers(60, size=n)] + 0.6 * rng.normal(size=(n, 24))
        table = spark.createDataFrame(pa.table({"vec_id": np.arange(n), "embedding": list(x.astype(np.float64))}))
        got = S.nearest(table, every=n // 40).toPandas()
        hit = 0
        for i in range(0, n, n // 40):
            d = ((x - x[i]) ** 2).sum(1)
            d[i] = np.inf
            hit += len(set(got[got.query_id == i].vec_id) & set(np.argsort(d)[:10]))
        assert hit / (10 * len(range(0, n, n // 40))) >= 0.95
