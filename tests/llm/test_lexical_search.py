"""Rankings against scoring every document, and MaxScore on its own."""

import math
import random
import re
from collections import Counter

import duckdb
import numpy as np
import pytest

from lodestride.llm import lexical_search as ls

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
DOCS, ITEMS = "doc_id long, text string", "item_id long, text string"


def terms(text):
    return TERM.findall((text or "").translate(UPPER))


def plain(docs, items, top=50):
    docs = [(i, Counter(t), len(t)) for i, t in ((i, terms(t)) for i, t in docs) if t]
    n, total = len(docs), sum(d[2] for d in docs)
    df = Counter(t for _, c, _ in docs for t in c)
    asked = {}
    for i, text in items:
        asked.setdefault(i, set()).update(terms(text))
    out = []
    for item, words in asked.items():
        scored = []
        for i, c, length in docs:
            m = 50 + 50 * length * n // total
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 20 * m)) for t in words if c[t])
            if s > 0:
                scored.append((-s, i is None, i))
        for rank, (s, _, i) in enumerate(sorted(scored)[:top], 1):
            out.append((item, rank, i, -s))
    return sorted(out, key=str)


def corpus(n, seed=1):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(120)] + ["Été", "日本", "don't", "A1", "x_y"]
    weights = [1 / (1 + i) for i in range(len(words))]
    text = lambda k: " ".join(rng.choices(words, weights, k=k))
    docs = [(i * 2, text(rng.randrange(1, 60))) for i in range(n)]
    docs += docs[:3] + [(9_001, None), (9_003, ""), (9_005, " ..!"), (9_007, "w3 " * 20_000)] + [(10_000 + i, "w5 w7 w9") for i in range(80)]  # ties beyond the last place
    items = [(i, text(rng.randrange(1, 15))) for i in range(25)] + [(3, "w1 W2"), (100, None), (101, "?!"), (102, "nowhere"), (103, "w5 w7 w9"), (None, "été w11")]
    return docs, items


def result(df):
    return sorted((tuple(r) for r in df.select("item_id", "rank", "doc_id", "score").collect()), key=str)


@pytest.mark.parametrize("shard_bytes,seed_rows,most_items", [(400, 20, 7), (ls.SHARD_BYTES, 0, ls.BLOCK_ITEMS)])
def test_rankings_by_scoring_all(spark, shard_bytes, seed_rows, most_items):
    docs, items = corpus(400)
    got = ls.rank_documents(spark.createDataFrame(docs, DOCS).repartition(6), spark.createDataFrame(items, ITEMS), shard_bytes=shard_bytes, seed_rows=seed_rows, most_items=most_items)
    assert result(got) == plain(docs, items)


def test_sql_gives_the_same(spark):
    docs, items = corpus(60, 2)
    items = [x for x in items if x[0] is not None]
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.execute("CREATE TABLE benchmark (item_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", docs)
    con.executemany("INSERT INTO benchmark VALUES (?, ?)", items)
    assert sorted(con.execute(ls.SQL).fetchall(), key=str) == plain(docs, items)


def test_non_essential_lists_are_only_probed():
    """Documents that have non-essential terms alone are never scored."""
    texts = [[b"rare", b"common"], *[[b"common"]] * 50, [b"rare", b"common", b"common"]]
    shard = ls.build_shard(list(range(52)), texts, {b"rare": 0, b"common": 1}, np.array([5000, 10]), 52, 105)
    ranking = ls.Ranking(2, threshold=int(shard.bound[1]) + 1)
    seen = []
    ranking.add = lambda score, ids: seen.extend(ids.tolist())
    ls.max_score(shard, np.array([0, 1]), ranking)
    assert seen == [0, 51]
    high = ls.Ranking(2, threshold=int(shard.bound.sum()) + 1)
    high.add = lambda score, ids: pytest.fail("no document can qualify")
    ls.max_score(shard, np.array([0, 1]), high)


def test_empty_tables_and_clashing_columns(spark):
    none_docs, none_items = spark.createDataFrame([], DOCS), spark.createDataFrame([], ITEMS)
    docs, items = corpus(30, 4)
    some_docs, some_items = spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS)
    assert ls.rank_documents(none_docs, some_items).collect() == []
    assert ls.rank_documents(some_docs, none_items).collect() == []
    assert ls.rank_documents(spark.createDataFrame([(1, None)], DOCS), some_items).collect() == []
    wide = some_docs.selectExpr("*", "1 AS item", "2 AS score", "3 AS rank", "4 AS salt", "5 AS item_id")
    assert result(ls.rank_documents(wide, some_items.selectExpr("*", "1 AS id", "2 AS item"))) == plain(docs, items)


def test_null_document_ids_come_last(spark):
    docs = [(None, "same words"), (5, "same words"), (None, "same words"), (2, "same words")] + [(100 + i, "other") for i in range(9)]
    items = [(1, "same words")]
    assert [r[2] for r in sorted(tuple(r) for r in ls.rank_documents(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS)).select("rank", "score", "doc_id").collect())] == [2, 5, None, None]
