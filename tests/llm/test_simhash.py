import random

import numpy as np
import pytest
import xxhash

from lodestride.llm import simhash as S
from lodestride.llm.components import components


def plain_fingerprint(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words, word = [], ""
    for c in low + " ":
        if c in " \t\n\v\f\r":
            words += [word] if word else []
            word = ""
        else:
            word += c
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints):
    """prints: id -> fingerprint; id -> smallest reachable id."""
    ids = sorted(prints)
    label = {i: i for i in ids}
    changed = True
    while changed:
        changed = False
        for i in ids:
            for j in ids:
                if (prints[i] ^ prints[j]).bit_count() <= 2 and label[j] < label[i]:
                    label[i], changed = label[j], True
    return label


def test_fingerprint_matches_plain():
    rng = random.Random(0)
    texts = ["", " \n", "one", "One two", "a b c", "É Ça\x1fx y z w", "w " * 50]
    texts += [" ".join(rng.choices(["Ab", "c", "dé", "\t", "É"], k=rng.randint(1, 30))) for _ in range(50)]
    for t in texts:
        assert S.fingerprint(t) == plain_fingerprint(t), t


def test_allocation_is_optimal():
    rng = np.random.default_rng(0)
    costs = np.cumsum(np.concatenate([np.zeros((40, 3, 1)), rng.random((40, 3, 3))], 2), 2)
    got = S.allocate(costs, 2)
    from itertools import product

    for row in range(40):
        best = min(sum(costs[row, i, t[i] + 1] for i in range(3)) for t in product(range(-1, 3), repeat=3) if sum(t) == 0)
        assert got[row].sum() == 0
        assert sum(costs[row, i, got[row, i] + 1] for i in range(3)) == pytest.approx(best)


@pytest.mark.parametrize("max_bucket", [50_000, 20])
def test_links_lose_nothing(spark, max_bucket):
    rng = random.Random(3)
    base = [rng.getrandbits(64) for _ in range(60)]
    prints = list(base)
    for _ in range(120):  # chains of neighbours
        x = rng.choice(prints)
        for _ in range(rng.randint(1, 3)):
            x ^= 1 << rng.randrange(64)
        prints.append(x)
    hot = rng.getrandbits(64)
    prints += [hot ^ sum(1 << b for b in rng.sample(range(24), rng.randint(0, 4))) for _ in range(150)]
    prints = dict(enumerate(dict.fromkeys(prints)))
    rows = [(int(np.uint64(p).view(np.int64)), i) for i, p in prints.items()]
    edges = S.links(spark.createDataFrame(rows, "fp long, node long").repartition(5), max_bucket=max_bucket)
    got = {r.node: r.component for r in components(edges).collect()}
    want = plain_components(prints)
    assert {i: got.get(i, i) for i in prints} == want


def test_documents(spark):
    words = [f"w{i}" for i in range(400)]
    text = " ".join(words)
    near = " ".join(words[:-1] + ["other"])
    rows = [(5, text, "x"), (3, near, "x"), (9, text.upper(), "x"), (9, text.upper(), "x"), (2, None, "x"), (7, "", "x"), (8, " \t", None), (4, "short", "x"), (None, text, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fp string")
    got = S.near_duplicates(docs).collect()
    assert len(got) == len(rows)
    label = {r.doc_id: r.component_id for r in got}
    prints = {r.doc_id: int(r.fingerprint, 16) for r in got}
    assert all(prints[i] == plain_fingerprint(t) for i, t, _ in rows)
    want = plain_components({i: p for i, p in prints.items() if i is not None})
    assert {i: c for i, c in label.items() if i is not None} == want
    assert want[7] == want[8] == 2 and want[9] == want[5]
    assert S.near_duplicates(docs.limit(0)).count() == 0
    stay = S.one_of_each(docs, words_per_shingle=3)
    assert stay.columns == docs.columns and {r.doc_id for r in stay.collect()} == {None, *want.values()}


def test_near_copies_of_similarity_over_eight_tenths_meet(spark):
    rng = random.Random(5)
    rows, pairs = [], []
    for i in range(0, 300, 2):
        words = [f"w{rng.randrange(3000)}" for _ in range(300)]
        other = list(words)
        for _ in range(4):  # each changes up to five of 296 shingles: similarity of 0.87 or more
            other[rng.randrange(300)] = "new"
        rows += [(i, " ".join(words)), (i + 1, " ".join(other))]
        pairs.append((i, i + 1))
    hub = [f"h{j}" for j in range(300)]
    for i in range(1000, 1150):
        rows.append((i, " ".join([*hub[: i - 900], f"x{i}", *hub[i - 899 :]])))
    got = {r.doc_id: r.component_id for r in S.near_copies(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()}
    assert sum(got[b] == a for a, b in pairs) >= 0.95 * len(pairs)
    assert all(got[a] == a for a, _ in pairs)
    assert {got[i] for i in range(1000, 1150)} == {1000}


def test_spreading_gives_all_components():
    rng = np.random.default_rng(4)
    for radius in (3, 28):
        fps = rng.integers(0, 2**63, (12, 1), np.uint64) ^ (np.uint64(1) << rng.integers(0, 64, (12, 10), np.uint64))
        fps = fps.reshape(-1, 1)
        apart = np.bitwise_count(fps ^ fps.T) > radius
        root = S.link_bucket(fps, radius)
        assert (root == S._roots(len(fps), *np.nonzero(~apart))).all()


def test_components(spark):
    path = [(i, i + 1) for i in range(0, 60)]
    star = [(100, i) for i in range(101, 140)]
    edges = spark.createDataFrame([*path, *star, (7, 7), (3, 2), (None, 5)], "a long, b long")
    got = {r.node: r.component for r in components(edges).collect()}
    assert got == {i: 0 for i in range(61)} | {i: 100 for i in range(100, 140)}


def jaccard(a, b, n=5):
    a, b = ({tuple(t.split()[i : i + n]) for i in range(len(t.split()) - n + 1)} for t in (a, b))
    return len(a & b) / len(a | b)


def edited(rng, size, edits):
    """A text and a copy with ``edits`` words changed."""
    words = [f"w{rng.randrange(5000)}" for _ in range(size)]
    other = list(words)
    for at in rng.sample(range(size), edits):
        other[at] = f"n{rng.randrange(5000)}"
    return " ".join(words), " ".join(other)


def test_near_copies_are_those_of_true_jaccard(spark):
    rng = random.Random(11)
    texts = [edited(rng, 200, rng.choice([4, 5, 6])) for _ in range(400)]  # similarity of 0.72 to 0.85
    rows = [(2 * i + k, t) for i, pair in enumerate(texts) for k, t in enumerate(pair)]
    got = {r.doc_id: r.component_id for r in S.near_copies(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()}
    near = {2 * i for i, pair in enumerate(texts) if jaccard(*pair) >= 0.8}
    linked = {i for i in range(0, 800, 2) if got[i + 1] == i}
    assert len(near) >= 80 and all(got[i] == i for i in range(0, 800, 2))
    assert linked <= near and len(linked) >= 0.97 * len(near)


@pytest.mark.parametrize("block_bytes", [1 << 25, 3000])
def test_groups_are_linked_by_true_jaccard(spark, block_bytes):
    rng = random.Random(12)
    base = [f"w{rng.randrange(5000)}" for _ in range(60)]
    texts = [" ".join(base)]
    for _ in range(60):  # a tree of copies, each one word from another
        words = rng.choice(texts).split()
        words[rng.randrange(60)] = f"n{rng.randrange(5000)}"
        texts.append(" ".join(words))
    label = list(range(len(texts)))
    near = [[j for j in range(len(texts)) if j == i or jaccard(texts[i], texts[j]) >= 0.85] for i in range(len(texts))]
    for _ in texts:
        label = [min(label[j] for j in js) for js in near]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    groups = [(S._set_key(x), i, 0, len(x)) for i, t in enumerate(texts) for x in [np.unique(S.shingle_hashes(t, 5))]]
    groups = spark.createDataFrame(groups, "key binary, node long, group long, size long")
    edges = S._similar(docs, groups, "doc_id", "text", 5, 0.85, block_bytes)
    got = {r.node: r.component for r in components(edges).collect()}
    assert 1 < len(set(label)) < len(texts)
    assert [got.get(i, i) for i in range(len(texts))] == label


def test_large_buckets_of_lanes_lose_nothing(spark):
    rng = np.random.default_rng(6)
    wide = rng.integers(0, 2**63, (300, 8), np.uint64)
    wide[:, 0] = 7  # all in the same buckets of the first lane
    for i in range(0, 300, 2):  # pairs with 70 to 100 differing bits of the other lanes
        bits = rng.permutation(448)[: 70 + i % 31]
        wide[i + 1] = wide[i]
        np.bitwise_xor.at(wide[i + 1], 1 + bits // 64, np.uint64(1) << (bits % 64).astype(np.uint64))
    first = spark.createDataFrame([(0, 7, i, bytearray(w.tobytes())) for i, w in enumerate(wide)], "lane long, fp long, node long, wide binary")
    edges = S.links(first, 4, 5, max_bucket=40, index_only=True, reach=102)
    assert {(r.a, r.b) for r in edges.collect()} == {(i, i + 1) for i in range(0, 300, 2)}
