"""The incremental learner against plain loops, and on a planted policy."""

import datetime as dt
import math
import random
import zlib

import numpy as np
import pytest

from lodestride.operators import decisions, online

SCHEMA = "session_date date, arm int, reward double, pi_old double, a double, b double"
FEATURES = ["a", "b"]


def table(days=6, each=300, seed=1):
    rng = random.Random(seed)
    out = []
    for d in range(days):
        for _ in range(each):
            arm, a, b = rng.randrange(5), rng.uniform(-1, 1), rng.choice([0.0, 1.0])
            out.append((dt.date(2024, 1, 1 + d), arm, 2.0 * arm + (3 - arm) * a + b + rng.gauss(0, 0.1), rng.choice([0.1, 0.2, 0.5]), a, b))
    return out


def plain(rows, weights, rate):
    """One pass in dictionaries by feature name."""
    loss = 0.0
    for _, arm, reward, pi, a, b in rows:
        x = {"a": a, "b": b, "constant": 1.0}
        w = weights.setdefault(arm, {})
        error = -reward - sum(w.get(k, 0.0) * v for k, v in x.items())
        loss += error**2
        square = sum(v * v for v in x.values())
        for k, v in x.items():
            w[k] = w.get(k, 0.0) + error * (1 - math.exp(-rate * square / pi)) / square * v
    return loss / len(rows)


def test_one_task_equals_plain_loops(spark):
    rows, weights, losses = table(3), {}, []
    df = spark.createDataFrame(rows, SCHEMA).coalesce(1)
    for d in range(3):
        losses.append(plain([r for r in rows if r[0].day == d + 1], weights, 0.05))
    model, by_day = online.learn_days(df, FEATURES)
    assert [r["loss"] for r in by_day.orderBy("session_date").collect()] == pytest.approx(losses, rel=1e-9)
    for arm, w in weights.items():
        for k, v in w.items():
            assert model[arm][zlib.crc32(k.encode()) % (1 << online.BITS)] == pytest.approx(v, rel=1e-9)
    # Warm start: days learned one call after another are the days learned in one.
    first = online.learn_days(df.where("session_date < DATE '2024-01-03'"), FEATURES)[0]
    again = online.learn_days(df.where("session_date = DATE '2024-01-03'"), FEATURES, model=first)[0]
    assert np.allclose(again, model)


def test_losses_fall_and_the_policy_is_found(spark):
    rows = table(8, 400)
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    model, by_day = online.learn_days(df, FEATURES)
    losses = [r["loss"] for r in by_day.orderBy("session_date").collect()]
    assert losses[-1] < 0.2 * losses[0] and [r["n"] for r in by_day.collect()] == [400] * 8
    scored = online.with_costs(df, FEATURES, model).collect()
    assert sum(int(np.argmin(r["costs"])) == max(range(5), key=lambda k: 2 * k + (3 - k) * r["a"]) for r in scored) > 0.85 * len(scored)
    for r in scored[:50]:
        x = {"a": r["a"], "b": r["b"], "constant": 1.0}
        assert r["costs"] == pytest.approx([sum(model[k][zlib.crc32(n.encode()) % (1 << online.BITS)] * v for n, v in x.items()) for k in range(5)], rel=1e-9)
    gate = decisions.deploy_gate(by_day.selectExpr("'m' AS model_id", "session_date AS run_at", "loss"))
    assert gate.where("deploy").count() >= 6


def test_importance_never_overshoots():
    model, seen = online.empty_model(4), np.zeros((5, 16))
    online.learn(model, np.array([1]), np.array([[2.0]]), np.array([0]), np.array([-10.0]), np.array([1e9]), 0.05, seen)
    assert model[0][1] * 2.0 == pytest.approx(-10.0) and seen[0][1] == 1


def test_edges(spark):
    model = online.empty_model()
    empty = spark.createDataFrame([], SCHEMA)
    after, n, loss = online.learn_day(empty, FEATURES, model)
    assert (after == model).all() and n == 0 and loss is None
    odd = [(dt.date(2024, 1, 1), None, 1.0, 0.2, 1.0, 1.0), (dt.date(2024, 1, 1), 2, None, 0.2, 1.0, 1.0), (dt.date(2024, 1, 1), 2, 3.0, None, None, math.nan), (dt.date(2024, 1, 1), 2, 3.0, 0.0, 0.0, 0.0)]
    after, n, loss = online.learn_day(spark.createDataFrame(odd, SCHEMA), FEATURES, model)
    assert n == 2 and math.isfinite(loss) and np.isfinite(after).all()
