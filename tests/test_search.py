"""Proposals beat random search on a planted optimum; pruning and seeds behave."""

import math

import numpy as np

from lodestride.operators import search as S

SPACE = {"rate": S.Range(1e-4, 1.0, log=True), "depth": S.Range(1, 12, whole=True), "share": S.Range(0.0, 1.0), "kind": S.Choice(("a", "b", "c"))}


def planted(params, fold):
    off = (math.log10(params["rate"]) + 2) ** 2 + ((params["depth"] - 7) / 4) ** 2 + (2 * (params["share"] - 0.3)) ** 2 + (params["kind"] != "b")
    return off + 0.01 * fold


def test_proposals_beat_random_search():
    wins, tpe, blind = 0, [], []
    for seed in range(12):
        a = S.best(S.search(SPACE, planted, 2, 60, seed=seed)).loss
        b = S.best(S.search(SPACE, planted, 2, 60, seed=seed, startup=10**6)).loss
        tpe.append(a)
        blind.append(b)
        wins += a < b
    assert wins >= 9 and np.median(tpe) < 0.6 * np.median(blind)


def test_a_seed_gives_one_table_and_pruned_trials_stop(spark):
    one, two = (S.search(SPACE, planted, 3, 40, seed=5) for _ in range(2))
    assert [(t.params, t.losses, t.state) for t in one] == [(t.params, t.losses, t.state) for t in two]
    assert one[0].params != S.search(SPACE, planted, 3, 1, seed=6)[0].params
    pruned = [t for t in one if t.state == "pruned"]
    assert pruned and all(len(t.losses) < 3 for t in pruned) and all(len(t.losses) == 3 for t in one if t.state == "complete")
    for t in pruned:  # worse than the median of earlier rounds at its last fold
        k = len(t.losses)
        others = [sum(o.losses[:k]) / k for o in one[: t.number // 4 * 4] if len(o.losses) >= k]
        assert len(others) >= 5 and t.loss > np.median(others)
    assert S.best(one).state == "complete" and not any(len(t.losses) < 3 and t is S.best(one) for t in one)
    rows = S.as_table(spark, one).collect()
    assert len(rows) == 40 and {r["state"] for r in rows} == {"complete", "pruned"} and set(rows[0]["params"]) == set(SPACE)


def test_settings_stay_in_their_ranges():
    seen = S.search(SPACE, lambda p, f: -p["rate"], 1, 80, seed=1)  # the optimum is at an edge
    assert all(1e-4 <= t.params["rate"] <= 1.0 and 1 <= t.params["depth"] <= 12 and isinstance(t.params["depth"], int) and t.params["kind"] in "abc" for t in seen)
    assert S.best(seen).params["rate"] > 0.5


def test_a_loss_that_is_no_number_never_wins():
    done = S.search({"x": S.Range(0, 1)}, lambda p, f: math.nan if p["x"] > 0.5 else p["x"], 1, 30, seed=3)
    assert math.isfinite(S.best(done).loss)
