import random

import numpy as np

from lodestride.llm import toxicity as X
from lodestride.llm.sampling import crc


def test_margin_equals_all_pairs():
    rng = np.random.default_rng(0)
    m = X.Model(0.3, rng.normal(size=30), rng.normal(size=(30, 4)))
    rows = [np.array([], np.int64), np.array([3]), np.array([1, 5, 7, 20])]
    for row, got in zip(rows, m.margin(rows)):
        want = 0.3 + sum(m.linear[i] for i in row) + sum(m.factors[i] @ m.factors[j] for i in row for j in row if i < j)
        assert np.isclose(got, want)


def test_pairs_are_learned():
    """Toxic just when both words meet, which no linear weights can express with this margin."""
    rng = random.Random(0)
    texts, labels = [], []
    for _ in range(1500):
        a, b = rng.random() < 0.5, rng.random() < 0.5
        texts.append(" ".join([*(["insult"] if a else []), *(["group"] if b else []), *rng.choices("u v w x y z".split(), k=5)]))
        labels.append(float(a and b))
    score = scores(texts, labels, ("insult group x", "insult x", "group y", "x y"))
    assert score[0] > 0.9 and max(score[1:]) < 0.1


def scores(texts, labels, asked):
    hashes = X.Hashes()
    model = X.fit([hashes.of(t) for t in texts], np.array(labels))
    return model.score([hashes.of(t) for t in asked])


def test_pairs_of_terms_without_an_effect_of_their_own():
    """Toxic just when one of both words is there: neither has a single-term effect."""
    rng = random.Random(1)
    texts, labels = [], []
    for _ in range(3000):
        a, b = rng.random() < 0.5, rng.random() < 0.5
        texts.append(" ".join([*(["insult"] if a else []), *(["group"] if b else []), *rng.choices([f"w{i}" for i in range(200)], k=12)]))
        labels.append(float(a != b))
    score = scores(texts, labels, ("insult w1 w2 w3", "group w4 w5 w6", "insult group w7 w8", "w9 w10 w11"))
    assert min(score[:2]) > 0.9 and max(score[2:]) < 0.1


def test_pairs_count_however_many_other_terms_are_more_frequent():
    """Two words in 8 % of the documents, toxic when both are there, among more frequent other terms."""
    rng = np.random.default_rng(7)
    n = 6000
    a, b = rng.random((2, n)) < 0.08
    labels = ((a & b) | (rng.random(n) < 0.02)).astype(float)
    for others in (400, 3500):
        rest = rng.random((n, others)) < 0.09
        features = [np.r_[np.flatnonzero([x, y]), np.flatnonzero(r) + 2] for x, y, r in zip(a, b, rest)]
        assert {0, 1} <= set(X.selected_terms(features, labels).tolist())


def test_blocks_change_no_effect(monkeypatch):
    rng = np.random.default_rng(2)
    features = [np.flatnonzero(rng.random(60) < 0.3) for _ in range(1500)]
    labels = np.array([float((3 in f) != (9 in f)) for f in features])
    whole = X.pair_effects(features, labels, np.arange(60))
    monkeypatch.setattr(X, "PAIR_BLOCK", 7)
    assert np.array_equal(whole, X.pair_effects(features, labels, np.arange(60)))
    assert whole[3] > 100 and whole[9] > 100 and np.sort(whole)[-3] < 60
    # Counted pair by pair.
    both = sum((3 in f) and (9 in f) for f in features)
    assert both >= X.PAIR_DOCS


def test_held_out_rows_and_edges(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    odd = spark.createDataFrame([(-1, None), (-2, ""), (-3, "fine " * 100_000), (-3, "fine " * 100_000), (None, "idiot")], "doc_id long, text string")
    got = X.score_toxicity(docs.union(odd), labels).toPandas()
    assert len(got) == docs.count() + 5 and got["score"].between(0, 1).all()
    assert ((got["score"] >= X.THRESHOLD) == (got["predicted"] == 1)).all()
    assert all(h == (crc(str(int(i))) % 3 == 1) for i, h in zip(got["doc_id"], got["held_out"]) if i == i and i is not None)
    truth = got[got["held_out"]].merge(labels.toPandas(), on="doc_id")
    hit = truth[truth["predicted"] == 1]
    assert (hit["toxic"] == 1).mean() > 0.95
    assert (truth[truth["toxic"] == 1]["predicted"] == 1).mean() > 0.7
    none = X.score_toxicity(odd, labels.limit(0)).toPandas()
    assert (none["score"] == 0).all() and len(none) == 5
    assert X.score_toxicity(docs.limit(0), labels).count() == 0


def test_one_id_on_many_rows_and_clashing_columns(spark):
    rows = [(6, f"you idiot group {i}", "s") for i in range(200)] + [(i, "a fine day", "s") for i in range(100, 200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string")
    labels = spark.createDataFrame([(6, 1), (6, None), (6, 0), *((i, 0) for i in range(100, 200))], "doc_id long, toxic int")
    got = X.score_toxicity(docs, labels).toPandas()
    assert len(got) == 300 and got["score"].between(0, 1).all()
