from collections import Counter, defaultdict

import pytest

from lodestride.llm import mixing
from lodestride.llm.mixing import mix, mixed_documents


def edf(parts):
    """Reference schedule of one cycle."""
    total, served, out = sum(parts.values()), Counter(), []
    for t in range(total):
        ready = [(-(-(served[s] + 1) * total // m), s) for s, m in sorted(parts.items()) if served[s] < m and served[s] * total // m <= t]
        due, s = min(ready)
        assert due > t
        served[s] += 1
        out.append(s)
    return out


def docs_of(spark, sizes):
    rows = [(i, s) for s, n in sizes.items() for i in range(n)]
    return spark.createDataFrame([(k, s, "row") for k, (_, s) in enumerate(rows)], "doc_id long, source string, slot string")


def slots_of(rows):
    slots = {}
    for r in rows:
        assert slots.setdefault(r.slot, (r.mix_source, r.block)) == (r.mix_source, r.block)
    assert sorted(slots) == list(range(len(slots)))  # gapless
    return [slots[t][0] for t in range(len(slots))]


def deviation(order, weights):
    """Largest distance from the weights, in blocks, while no source has run out."""
    last, seen, worst = {s: max(t for t, x in enumerate(order) if x == s) for s in weights}, Counter(), 0.0
    for t in range(min(last.values())):
        seen[order[t]] += 1
        worst = max(worst, *(abs(seen[s] - (t + 1) * w) for s, w in weights.items()))
    return worst


def test_schedule_and_deviation(spark):
    sizes, weights = {"a": 5000, "b": 900, "c": 60}, {"a": 0.55, "b": 0.35, "c": 0.1}
    rows = mix(docs_of(spark, sizes), weights, block_docs=4).collect()
    assert len(rows) == sum(sizes.values()) and len({r.row.doc_id for r in rows}) == len(rows)
    assert all(r.release <= r.slot < r.due for r in rows)
    order = slots_of(rows)
    assert order[:20] == edf({"a": 11, "b": 7, "c": 2})
    assert deviation(order, weights) < 1
    seen, left = Counter(), order[160 : 160 + 18 * 20]  # c is gone: the others, at their relative weights
    for t, s in enumerate(left, 1):
        seen[s] += 1
        assert abs(seen["a"] - t * 11 / 18) < 2  # of two points in one phase, each less than one block off


@pytest.mark.parametrize("weights", [{"a": 0.1234, "b": 0.8766}, {"a": 1e-4, "b": 1 - 1e-4}, {"a": 1 / 3, "b": 1 / 7, "c": 1 - 1 / 3 - 1 / 7}])
def test_any_weights_keep_the_bound(spark, weights):
    sizes = {s: 1 + int(12_000 * w) for s, w in weights.items()}
    order = slots_of(mix(docs_of(spark, sizes), weights, block_docs=1).collect())
    assert deviation(order, weights) < 1


def test_three_hundred_sources(spark):
    sizes = {f"s{i:03}": 1 + 7 * i % 90 for i in range(300)}
    rows = mix(docs_of(spark, sizes), block_docs=2).collect()
    assert len(rows) == sum(sizes.values()) and all(r.release <= r.slot < r.due for r in rows)
    order = slots_of(rows)
    total = sum(n**0.5 for n in sizes.values())
    assert deviation(order, {s: n**0.5 / total for s, n in sizes.items()}) < 1


def test_more_sources_than_one_schedule_holds(spark):
    sizes = {f"s{i:03}": 3 + 11 * i % 40 for i in range(90)}
    rows = mix(docs_of(spark, sizes), block_docs=1, max_sources=10).collect()
    assert len(rows) == sum(sizes.values()) and len({r.row.doc_id for r in rows}) == len(rows)
    total = sum(n**0.5 for n in sizes.values())
    # Less than one block of its own, and its part of the less than one block that its group is off.
    assert deviation(slots_of(rows), {s: n**0.5 / total for s, n in sizes.items()}) < 1 + max(r.share for r in rows if r.block == 0)


def test_seven_hundred_sources_with_two_levels(spark):
    sizes = {f"s{i:03}": 3 + 5 * i % 17 for i in range(700)}
    rows = mix(docs_of(spark, sizes), block_docs=1).collect()
    assert len(rows) == sum(sizes.values())
    # Parts of groups while all sources have blocks.
    total, part = sum(n**0.5 for n in sizes.values()), max(r.share for r in rows if r.block == 0)
    assert part < 0.02 and deviation(slots_of(rows), {s: n**0.5 / total for s, n in sizes.items()}) < 1 + part


def test_nulls_names_and_unnamed_sources(spark):
    docs = docs_of(spark, {"a": 300, "(null)": 5, None: 5, "(rest)": 7, "": 3, "=": 2})
    got = Counter(r.mix_source for r in mix(docs).collect())
    assert got == {"a": 300, "(null)": 5, None: 5, "(rest)": 7, "": 3, "=": 2}
    named = mix(docs, {"a": 0.5}, rest_weight=0.5, block_docs=1).collect()
    assert len(named) == 322
    first = Counter(r.mix_source for r in named if r.slot < 20)
    assert first["a"] in (10, 11)  # shares are rounded to a billionth
    last = mix(docs, {"a": 1.0}, block_docs=1).collect()  # the rest has no weight and comes last
    assert {r.mix_source for r in last if r.slot < 290} == {"a"}
    assert mix(docs.limit(0)).count() == 0


def test_repeated_and_null_ids_in_bulk(spark, monkeypatch):
    monkeypatch.setattr(mixing, "RANK_ROWS", 100)
    rows = [(None, "a", "x")] * 700 + [(7, "a", "y")] * 300 + [(i, "b", "z") for i in range(100, 400)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, mix_source string")
    got = mix(docs).collect()
    assert len(got) == 1300 and len({r.mix_order for r in got}) == 1300
    assert Counter(r.row.mix_source for r in got) == {"x": 700, "y": 300, "z": 300}
    slots_of(got)


def test_documents_come_out_in_order(spark):
    docs = docs_of(spark, {"a": 300, "b": 50})
    out = mixed_documents(docs)
    assert out.columns == docs.columns
    place = defaultdict(int, {r.row.doc_id: r.mix_order for r in mix(docs).collect()})
    orders = [place[r.doc_id] for r in out.collect()]
    assert orders == sorted(orders) and len(orders) == 350
