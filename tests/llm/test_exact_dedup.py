from collections import defaultdict
from hashlib import sha256

import pytest

from lodestride.llm.exact_dedup import distinct_documents, duplicate_groups

ROWS = [
    (1, "a", 10), (2, "b", 20), (3, "a", 30), (4, None, 40), (5, "", 50), (6, "a", 60), (6, "a", 61),
    (7, "x" * 300_000, 70), (8, "x" * 300_000, 80), (None, "b", 90), (9, "A", 95),
]


def brute(rows):
    groups = defaultdict(list)
    for i, text, _ in rows:
        groups[text or ""].append(i)
    out, kept = [], set()
    for text, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        for i in ids:
            first = i == keep and text not in kept
            kept |= {text} if first else set()
            out.append((i, keep, len(ids), first, sha256(text.encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("split_rows, max_large", [(8192, 10), (1, 100), (2, 100), (1, 0)])
def test_groups_match_brute_force(spark, split_rows, max_large):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string, digest int").repartition(3)
    got = duplicate_groups(docs, split_rows=split_rows, max_large=max_large)
    assert sorted(map(tuple, got.collect()), key=str) == brute(ROWS)
    stays = distinct_documents(docs, split_rows=split_rows, max_large=max_large)
    assert stays.columns == docs.columns
    assert sorted(r.doc_id for r in stays.collect()) == [2, 5, 6, 8, 9]


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert duplicate_groups(docs).count() == 0 and distinct_documents(docs).count() == 0


def test_clashing_names(spark):
    docs = spark.createDataFrame([(1, "a", 5, True), (2, "a", 6, False), (3, None, 7, None)], "doc_id long, text string, null_text long, `the.salt` boolean")
    assert sorted(map(tuple, distinct_documents(docs, split_rows=1).collect())) == [(2, "a", 6, False), (3, None, 7, None)]
    assert len(duplicate_groups(docs).collect()) == 3


def test_salts_of_a_large_digest_stay_apart(spark):
    docs = spark.range(4000).selectExpr("id AS doc_id", "'same' AS text")
    got = duplicate_groups(docs, split_rows=100)
    rows = got.collect()
    assert len(rows) == 4000 and {r.keep_id for r in rows} == {3999} and {r.group_size for r in rows} == {4000} and sum(r.kept for r in rows) == 1
