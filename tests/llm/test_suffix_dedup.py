import random
from hashlib import sha256

import pytest

from lodestride.llm import suffix_dedup as S


def brute(rows, length=100):
    """Rows (id, text) to (id, bytes, removed, spans, hash); equal rows are one document."""
    docs = sorted({(-(2**63) if i is None else i, (t or "").encode()) for i, t in rows})
    seen, out = set(), {}
    for i, data in docs:
        gone = bytearray(len(data))
        for p in range(len(data) - length + 1):
            w = data[p : p + length]
            if w in seen:
                gone[p : p + length] = b"\1" * length
            seen.add(w)
        spans = sum(1 for p in range(len(data)) if gone[p] and (p == 0 or not gone[p - 1]))
        kept = bytes(b for b, g in zip(data, gone) if not g)
        out[i, data] = (len(data), sum(gone), spans, sha256(kept).hexdigest())
    return sorted([(i, *out[-(2**63) if i is None else i, (t or "").encode()]) for i, t in rows], key=str)


def words(rng, n):
    return " ".join("".join(rng.choices("abcdeé", k=rng.randint(1, 7))) for _ in range(n))


def test_merged_transforms_give_the_repeated_windows():
    rng = random.Random(0)
    pool = [words(rng, 40).encode() for _ in range(3)]
    texts = []
    for _ in range(40):
        p = rng.choice(pool)
        at = rng.randrange(len(p) - 60)
        t = bytes(rng.choices(b"xy", k=rng.randint(0, 30))) + p[at : at + rng.randint(40, 120)] + bytes(rng.choices(b"xy", k=30))
        texts.append(t)
    import numpy as np

    order = np.array([(i, 0) for i in range(len(texts))])
    text, place = S.repeated_windows(texts, order, 40)
    seen, want = set(), set()
    for i, t in enumerate(texts):
        for p in range(len(t) - 39):
            if t[p : p + 40] in seen:
                want.add((i, p))
            seen.add(t[p : p + 40])
    assert set(zip(text.tolist(), place.tolist())) == want and len(want) > 100


def test_anchors_cover_every_window():
    rng = random.Random(1)
    texts = [words(rng, n).encode() for n in (3, 60, 200, 0, 25)]
    doc, place, h = S.anchors(texts)[:3]
    for i, t in enumerate(texts):
        mine = sorted(place[doc == i])
        for p in range(len(t) - 99):
            assert any(p <= a <= p + 68 for a in mine)
    twice, again = S.anchors([texts[1], b"zz" + texts[1]]), S.anchors([texts[1]])
    assert set(again[2]) <= set(twice[2])


@pytest.mark.parametrize("batch_rows", [10_000, 7])
def test_documents_match_brute_force(spark, batch_rows):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch_rows)
    rng = random.Random(2)
    passages = [words(rng, rng.randint(15, 60)) for _ in range(12)]
    rows = []
    for i in range(160):
        parts = [words(rng, rng.randint(0, 40)) for _ in range(rng.randint(0, 3))] + rng.choices(passages, k=rng.randint(0, 3))
        rng.shuffle(parts)
        rows.append((i * 3 % 161, " ".join(parts)))
    rows += [(500, passages[0] * 3), (501, "ab" * 300), (502, "a" * 700), (503, None), (504, ""), (505, "short"), (None, passages[1]), (None, passages[1])]
    rows += [(7, passages[2]), (7, passages[2]), (7, passages[3]), rows[0], (506, words(rng, 20_000))]
    docs = spark.createDataFrame([(*r, 0, "x") for r in rows], "doc_id long, text string, start int, found string").repartition(5)
    got = S.remove_repeats(docs)
    same_id = {i for i, _ in rows if i == 7}
    mine = sorted([tuple(r) for r in got.collect()], key=str)
    want = brute(rows)
    assert [r for r in mine if r[0] not in same_id] == [r for r in want if r[0] not in same_id]
    assert len(mine) == len(want)
    assert S.remove_repeats(docs.limit(0)).count() == 0
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def claim_rows(pairs):
    import pyarrow as pa

    kinds = {"doc_id": pa.int64(), "version": pa.int64(), "start": pa.int32(), "part": pa.binary(), "l_doc": pa.int64(), "l_version": pa.int64(), "l_start": pa.int32(), "other": pa.binary()}
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*pairs), kinds.values())], names=list(kinds))


def test_bytes_decide_on_claims():
    rng = random.Random(5)
    a, b = (words(rng, 100).encode()[:331] for _ in range(2))
    half = a[:150] + b[150:]
    rows = [(9, 1, 7, a, 3, 1, 40, a), (10, 1, 0, b, 3, 2, 0, a), (11, 1, 5, half, 4, 1, 0, a), (12, 1, 0, a[:100], 5, 1, 0, a[:100])]
    got = {}
    for batch in S._prove(100)(iter([claim_rows(rows)])):
        for r in batch.to_pylist():
            got.setdefault(r["doc_id"], set()).update(range(r["start"], r["end"]))
    assert set(got) == {9, 11, 12} and got[9] == set(range(7, 338)) and got[12] == set(range(100))
    # Of the half that differs from its claim, only what the batch holds elsewhere may go.
    assert set(range(5, 145)) <= got[11] and not got[11] & set(range(155, 156))


def test_nothing_is_removed_without_the_merge(spark, monkeypatch):
    import numpy as np

    rng = random.Random(6)
    passage = words(rng, 60).encode()
    monkeypatch.setattr(S, "merge", lambda shards, length: (np.arange(sum(len(s.place) for s in shards)), np.arange(sum(len(s.place) for s in shards))))
    batches = list(S._prove(100)(iter([claim_rows([(9, 1, 0, passage, 3, 1, 0, passage)])])))
    assert sum(b.num_rows for b in batches) == 0
    text, _ = S.repeated_windows([passage, passage], np.array([(0, 0), (1, 0)]))
    assert len(text) == 0
