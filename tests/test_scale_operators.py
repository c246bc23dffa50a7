"""Operators that were rebuilt for large tables: exact deals, distinct counts, EWMA states, bootstrap by units."""

import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from lodestride.operators import cleaning, daily, ewma, ope, sketches
from lodestride.sources import game


def test_stratified_split_deals_each_bin_exactly(spark, monkeypatch):
    rng = random.Random(4)
    rows = [(u, float(rng.choice([1, 2, 2, 3, 5, 8]) + rng.random())) for u in range(437) for _ in range(2)] + [(None, 2.0)]
    df = spark.createDataFrame(rows, "user_id long, x double")
    deals = []
    for cells in (cleaning.CELLS, 2, 1):  # few cells: most users are ranked
        monkeypatch.setattr(cleaning, "CELLS", cells)
        got = cleaning.stratified_split(df, "x")
        assert sorted(got.columns) == ["bin", "mean_value", "split", "user_id"]
        deals.append({r["user_id"]: (r["bin"], r["split"]) for r in got.collect()})
    assert deals[0] == deals[1] == deals[2] and len(deals[0]) == 438
    by_bin = {}
    for b, split in deals[0].values():
        by_bin.setdefault(b, []).append(split)
    assert len(by_bin) == 5
    for splits in by_bin.values():
        n = len(splits)
        assert (splits.count("train"), splits.count("validation")) == (n * 8 // 10, n // 10)


def test_stratified_split_ranks_only_users_of_cut_cells(spark):
    df = spark.range(20_000).selectExpr("id AS user_id", "CAST(id % 97 AS DOUBLE) AS x")
    split = cleaning.stratified_split(df, "x")
    assert {r["split"]: r["count"] for r in split.groupBy("split").count().collect()}["train"] in range(15_990, 16_001)
    plan = split._jdf.queryExecution().executedPlan().toString()
    assert "Window" in plan and "BroadcastHashJoin" in plan


def test_daily_distinct_counts_have_no_expand_and_go_when_unread(spark):
    rows = [
        (u, dt.datetime(2024, 1, 1 + n % 2, n % 24), ["view", "click", "error", "purchase"][n % 4], f'{{"k": {n % 9}}}', n)
        for u in (1, 2, None) for n in range(60)
    ]
    events = spark.createDataFrame([(n, ts, u, kind, float(n), props) for u, ts, kind, props, n in rows], "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string")
    keyed = events.withColumn("k", F.get_json_object("props", "$.k").cast("int"))
    table = daily.daily_features(keyed.select(*[F.expr(sql).alias(name) for name, sql in game.COLUMNS.items()]))
    want = {}
    for u, ts, kind, props, n in rows:
        sessions, levels = want.setdefault((u, ts.date()), (set(), set()))
        if u is not None:
            sessions.add((u, ts.hour))
        if kind != "purchase":
            levels.add(n % 9)
    got = {(r["user_id"], r["session_date"]): (r["daily_session_count"], r["distinct_levels_played"]) for r in table.collect()}
    assert got == {k: (len(s), len(lv)) for k, (s, lv) in want.items()}
    plan = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    assert "Expand" not in plan(table) and plan(table).count("Join") == 2
    assert "Join" not in plan(table.select("user_id", "session_date", "current_spend", "days_since_install"))
    assert plan(table.select("user_id", "daily_session_count")).count("Join") == 1


def history(days=40, users=6, seed=2):
    rng = random.Random(seed)
    value = lambda: rng.choice([None, math.nan, rng.uniform(-5, 50), rng.uniform(0, 3)])
    return [(u, dt.date(2024, 1, 1) + dt.timedelta(d), value(), value()) for u in range(users) for d in range(days) if rng.random() < 0.8 and (u or d > 30)]


SCHEMA = "user_id long, session_date date, x double, y double"


def averages(df):
    names = sorted(c for c in df.columns if c.startswith("ewma_"))
    return {(r["user_id"], r["session_date"]): [round(r[n], 9) for n in names] for r in df.collect()}


@pytest.mark.parametrize("steps", [(20, 21, 22, 23), (35,), (5, 30, 39)])
def test_ewma_from_states_equals_the_whole_history(spark, tmp_path, steps):
    rows = spark.createDataFrame(history(), SCHEMA).cache()
    want = averages(ewma.add_ewma(rows, ["x", "y"], (0.1, 0.7)))
    cuts = [dt.date(2024, 1, 1) + dt.timedelta(s) for s in steps]
    edges = [dt.date(2023, 1, 1), *cuts, dt.date(2025, 1, 1)]
    got, state = {}, None
    for i, (a, b) in enumerate(zip(edges, edges[1:])):
        out, fresh = ewma.advance(state, rows.where((F.col("session_date") >= F.lit(a)) & (F.col("session_date") < F.lit(b))), ["x", "y"], (0.1, 0.7))
        got |= averages(out)
        kept = fresh if state is None else state.join(fresh, "user_id", "left_anti").unionByName(fresh)
        kept.write.parquet(f"{tmp_path}/{i}")
        state = spark.read.parquet(f"{tmp_path}/{i}")
    assert got == want


def test_ewma_state_refuses_old_rows_and_other_averages(spark):
    rows = spark.createDataFrame([(1, dt.date(2024, 1, 2), 1.0, 2.0)], SCHEMA)
    state = ewma.advance(None, rows, ["x"], (0.3,))[1]
    with pytest.raises(Exception, match="not older"):
        ewma.advance(state, rows, ["x"], (0.3,))[1].collect()
    later = spark.createDataFrame([(1, dt.date(2024, 1, 3), 1.0, 2.0)], SCHEMA)
    with pytest.raises(Exception, match="other averages"):
        ewma.advance(state, later, ["x"], (0.5,))[1].collect()
    assert ewma.advance(state, later.where("false"), ["x"], (0.3,))[0].collect() == []


def observations(spark, users):
    rng = random.Random(8)
    rows = []
    for u in range(users):
        level = rng.gauss(100, 30)
        rows += [(u, rng.randrange(5), level + rng.gauss(0, 20), rng.choice([0.1, 0.2, 0.4]), rng.uniform(0.55, 1.2)) for _ in range(rng.randrange(1, 9))]
    return spark.createDataFrame(rows, "user_id long, arm int, reward double, pi_old double, multiplier double")


def test_bootstrap_by_units_agrees_with_bootstrap_by_users(spark):
    rows = observations(spark, 6000).cache()
    by_unit = {r["estimator"]: r for r in ope.bootstrap(rows, 400, units=512).collect()}
    by_user = {r["estimator"]: r for r in ope.bootstrap(rows, 400, units=None).collect()}
    for e, a in by_unit.items():
        b = by_user[e]
        # Errors of the deviation: 3.5 % from 400 replicates on either side and 3.1 % from 512 units.
        assert abs(a["std"] / b["std"] - 1) < 0.2
        assert abs(a["mean"] - b["mean"]) < 0.3 * b["std"]
        assert abs((a["high"] - a["low"]) / (b["high"] - b["low"]) - 1) < 0.25


def test_bootstrap_draws_do_not_grow_with_users(spark):
    few, many = observations(spark, 300), observations(spark, 3000)
    units = lambda df: df.select(ope.resampled_unit(F.col("user_id"), 64).alias("u")).distinct().count()
    assert units(few) <= 64 and units(many) == 64


def test_sketches_of_days_merge_within_their_rank_error(spark, tmp_path):
    rows = spark.range(120_000).selectExpr("date_add(DATE '2024-01-01', CAST(id % 30 AS INT)) AS session_date", "CAST(pmod(xxhash64(id), 1000003) AS DOUBLE) AS x", "IF(id % 3 = 0, double('NaN'), CAST(id % 5 AS DOUBLE)) AS y", "CAST(NULL AS DOUBLE) AS z")
    sketches.daily_sketches(rows, ["x", "y", "z"]).write.parquet(str(tmp_path / "s"))
    stored = spark.read.parquet(str(tmp_path / "s"))
    assert stored.count() == 90 and max(len(r["sketch"] or b"") for r in stored.collect()) < 120_000
    ps = [0.01, 0.25, 0.5, 0.75, 0.99]
    got = {(r["name"], r["p"]): r for r in sketches.quantiles(stored, ps, dt.date(2024, 1, 4), dt.date(2024, 1, 20)).collect()}
    picked = rows.where("session_date BETWEEN DATE '2024-01-04' AND DATE '2024-01-20'").cache()
    n = picked.count()
    assert {k[0] for k in got} == {"x", "y"}  # z has no value
    for p in ps:
        assert got["x", p]["n"] == n and abs(picked.where(F.col("x") <= got["x", p]["value"]).count() / n - p) < 0.004
    assert got["y", 0.5]["n"] == picked.where("NOT isnan(y)").count() and got["y", 0.5]["value"] == 2.0
