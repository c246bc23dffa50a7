"""Hand-built edge cases of the decision operators."""

from datetime import date, timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from lodestride.functions import arms as A
from lodestride.operators import actions, cleaning, daily, decisions, ewma, features, ope, records
from lodestride.sources import game, readers, writers
from lodestride.streaming import daily as streaming
from tests.conftest import DATA


def values(df, column):
    return [r[column] for r in df.collect()]


def test_feasible_arms_at_the_bounds(spark):
    rows = spark.createDataFrame([(i, m) for i, m in enumerate([0.50, 0.55, 0.56, 0.62, 1.13, 1.19, 1.20, 1.25, 0.30, None])], "i int, m double").orderBy("i")
    got = values(rows.select(A.feasible_flags(F.col("m")).alias("f")), "f")
    want = [[0.5 <= round(m + d, 6) <= 1.25 for d in (-0.12, -0.06, 0, 0.06, 0.12)] if m else [False] * 5 for m in [0.50, 0.55, 0.56, 0.62, 1.13, 1.19, 1.20, 1.25, 0.30, None]]
    assert [[x == 1 for x in f] for f in got] == want
    pi = values(rows.select(A.uniform_policy(F.col("m")).alias("p")), "p")
    assert all(sum(p) == pytest.approx(1) for p in pi) and pi[-1] == [0.2] * 5
    moved = values(rows.select(A.next_multiplier(F.col("m"), F.lit(4)).alias("x")), "x")
    assert moved[0] == pytest.approx(0.62) and moved[6] == 1.20 and moved[7] == 1.25 and moved[9] is None


def test_propensities_of_an_infeasible_choice(spark):
    row = spark.range(1).select(A.propensity_vector(F.lit(0.5), F.lit(0), F.lit(0.4)).alias("p"), A.propensity_vector(F.lit(0.8), F.lit(2), F.lit(0.4)).alias("q"), A.propensity_vector(F.lit(0.8), F.lit(2), F.lit(None).cast("double")).alias("u")).first()
    assert row.p == pytest.approx([0, 0, 1 / 3, 1 / 3, 1 / 3])
    assert row.q == pytest.approx([0.15, 0.15, 0.4, 0.15, 0.15]) and row.u == pytest.approx([0.2] * 5)
    picks = spark.sql("select explode(array(0.0D, 0.19D, 0.2D, 0.99D)) u").select(A.inverse_cdf(F.array(*[F.lit(0.2)] * 5), F.col("u")).alias("i"))
    assert values(picks, "i") == [0, 0, 1, 4]


def test_arms_need_a_next_row(spark):
    rows = [(1, date(2024, 1, d), m) for d, m in ((1, 0.8), (2, 0.86), (5, 0.74), (6, 0.74), (7, 1.1))] + [(2, date(2024, 1, 1), 0.5)]
    logged = spark.createDataFrame(rows, "user_id long, session_date date, multiplier double")
    got = actions.assign_arms(logged).orderBy("session_date")
    assert values(got, "difficulty_arm") == ["Harder", "Easierer", "Same"]
    assert values(actions.assign_arms(logged, strict_calendar=True).orderBy("session_date"), "difficulty_arm") == ["Harder", "Same"]
    inferred = actions.assign_arms_for_inference(logged)
    assert inferred.count() == 6 and inferred.where("difficulty_arm = 'Inference'").count() == 2


@pytest.mark.parametrize("alpha", [0.1, 0.3, 0.7])
def test_ewma_equals_pandas_with_nulls(spark, alpha):
    rng = np.random.default_rng(1)
    rows = [(u, date(2024, 1, 1) + timedelta(days=i), None if rng.random() < 0.3 else float(rng.normal())) for u in range(4) for i in range(40)]
    rows += [(9, date(2024, 1, 1) + timedelta(days=i), x) for i, x in enumerate([1.0, None, None, 4.0, None])]
    df = spark.createDataFrame(rows, "user_id long, session_date date, x double")
    got = ewma.add_ewma(df, ["x"], (alpha,)).toPandas().sort_values(["user_id", "session_date"])
    for _, g in got.groupby("user_id"):
        want = g["x"].ewm(alpha=alpha, adjust=False).mean().shift(1).fillna(0.0)
        assert np.allclose(g[ewma.name_of("x", alpha)], want, atol=1e-12)


def test_ewma_of_long_histories(spark):
    rng = np.random.default_rng(2)
    x = [10.0] + [None] * 450 + [float(v) if rng.random() < 0.8 else None for v in rng.normal(size=149)]
    y = [1000.0] * 500 + [0.0] * 100
    rows = [(u, date(2020, 1, 1) + timedelta(days=i), a, b) for u in (1, 2) for i, (a, b) in enumerate(zip(x, y))]
    df = spark.createDataFrame(rows, "user_id long, session_date date, x double, y double")
    alphas = (0.01, 0.02, 0.1)
    got = ewma.add_ewma(df, ["x", "y"], alphas).where("user_id = 1").toPandas().sort_values("session_date")
    assert len({c for c in got.columns if c.startswith("ewma_")}) == 6
    for c in ("x", "y"):
        for a in alphas:
            want = got[c].ewm(alpha=a, adjust=False).mean().shift(1).fillna(0.0)
            assert np.allclose(got[ewma.name_of(c, a)], want, rtol=1e-9, atol=1e-12)


def test_schemas_and_whitelists(spark):
    df = spark.createDataFrame([(1, "x", 0, None, 0.5), (2, None, 0, None, 0.7)], "USERID long, Segment string, zero int, nothing double, action double")
    low = cleaning.lower_cased(df)
    assert low.columns == ["user_id", "segment", "zero", "nothing", "action"]
    assert cleaning.without_dead_columns(low).columns == ["user_id", "segment", "action"]
    assert cleaning.selected(low, ["SEGMENT", "Action"], ("user_id",)).columns == ["user_id", "segment"]
    assert cleaning.without_leaks(["a", "Action"]) == ["a"]
    assert [tuple(r) for r in cleaning.encoded(low.select("user_id", "segment", F.lit(None).cast("timestamp").alias("t"))).orderBy("user_id").collect()] == [(1, 1), (2, 0)]
    with pytest.raises(ValueError):
        cleaning.distinct_values(spark.range(300), "id")
    assert 0 < cleaning.sampled(spark.range(20_000)).count() < 400
    assert ope.scale_factor(86.0, -0.43) == pytest.approx(200.0)
    with pytest.raises(ValueError):
        ope.scale_factor(1.0, 0.0)


def test_day_ranges_checkpoints_and_formats(spark, tmp_path):
    day = lambda d: date(2024, 1, d)
    df = spark.createDataFrame([(i, day(i), "old") for i in range(1, 6)], "user_id long, session_date date, v string")
    path = str(tmp_path / "t")
    writers.write_partitioned(df, path)
    writers.replace_days(df.where("user_id = 3").withColumn("v", F.lit("new")), path, day(2), day(4))
    assert sorted(map(tuple, readers.read_files(spark, path).select("user_id", "v").collect())) == [(1, "old"), (3, "new"), (5, "old")]
    with pytest.raises(ValueError):
        writers.replace_days(df, path, day(2), day(4))
    assert writers.write_checkpoint(df, str(tmp_path / "c")).count() == 5
    assert readers.read_checkpoint(spark, str(tmp_path / "c")).count() == readers.read_checkpoint(spark, str(tmp_path / "c.parquet")).count() == 5
    with pytest.raises(FileNotFoundError):
        readers.read_checkpoint(spark, str(tmp_path / "none"))
    df.write.parquet(str(tmp_path / "d"))
    (tmp_path / "d" / "_delta_log").mkdir()
    assert readers.format_of(spark, str(tmp_path / "d")) == "delta"
    with pytest.raises(FileNotFoundError):  # a log without a version tells of no rows
        readers.read_files(spark, str(tmp_path / "d"))
    other = df.select("user_id", F.lit("second").alias("v"), F.lit(1).alias("w")).where("user_id < 3")
    merged = readers.merged_with_first(df, other, ["user_id"]).orderBy("user_id")
    assert values(merged, "v") == ["old"] * 5 and values(merged, "w") == [1, 1, None, None, None]
    writers.write_report(df.select("user_id"), str(tmp_path / "r"))
    assert spark.read.json(str(tmp_path / "r")).count() == 5
    marked = df.withColumn("split", F.lit("train")).withColumn("record", F.lit("r"))
    writers.write_splits(marked, str(tmp_path / "s"), str(tmp_path / "st"))
    assert spark.read.parquet(str(tmp_path / "st")).columns == ["user_id", "session_date", "v", "split"]


def test_bulk_writes_are_tried_again(spark, tmp_path):
    mark = tmp_path / "failed"

    def put(rows):
        if not mark.exists():
            mark.write_text("once")
            raise OSError("busy")
        (tmp_path / "done").write_text(str(len(rows)))

    writers.write_bulk(spark.range(3).selectExpr("id AS k", "id AS v").coalesce(1), "k", "v", put, wait=0.0)
    assert (tmp_path / "done").read_text() == "3"


def test_record_forms(spark):
    rows = spark.createDataFrame([(42, date(2024, 1, 1), 0.25, 3, 120.0, 0.88, [0.1, 0.2, None, 0.4, 0.3])], "user_id long, session_date date, coin_balance double, arm int, reward double, multiplier double, probs array<double>")
    of = lambda form: values(records.cb_adf_records(rows, ["coin_balance"], form), "record")[0].split("\n")
    online, prediction, legacy = of("online"), of("prediction"), of("legacy")
    assert online[0] == "shared |f coin_balance:0.250000" and online[1] == "0:0:0.100000 |a arm:0" and online[3] == "2:0:0.200000 |a arm:2" and online[4] == "3:-120.0000:0.400000 |a arm:3"
    assert prediction[0] == "shared |e coin_balance:0.250000" and prediction[5] == "4 |a arm:4 delta:0.12 |c mult:0.88 feasible:1"
    assert legacy[3] == "|a arm:2 delta:0.00 |c mult:0.88 feasible:1" and legacy[4].startswith("3:-120.0000:0.400000 |a")
    with pytest.raises(ValueError):
        records.cb_adf_records(rows, [], "other")


def feature_rows(spark, rows):
    """rows: (user, day of January 2024, completion rate)."""
    base = spark.createDataFrame([(u, date(2024, 1, d), r) for u, d, r in rows], "user_id long, session_date date, completion_rate double")
    return base.withColumn("day_no", F.unix_date("session_date")).withColumn("current_effectivelevelmultiplier", F.lit(0.8))


def test_streaks(spark):
    rows = feature_rows(spark, [(1, d, r) for d, r in ((1, 1.0), (2, 1.0), (4, 0.0), (5, 1.0), (9, 1.0))])
    got = features.add_features(rows, ["consecutive_days_streak", "consecutive_wins_streak", "consecutive_losses_streak", "days_since_last_play", "time_at_current_difficulty"]).orderBy("session_date").collect()
    assert [r.consecutive_days_streak for r in got] == [0, 1, 2, 1, 2]
    assert [r.consecutive_wins_streak for r in got] == [0, 1, 2, 0, 1]
    assert [r.consecutive_losses_streak for r in got] == [0, 0, 0, 1, 0]
    assert [r.days_since_last_play for r in got] == [0, 0, 0, 1, 0]
    assert [r.time_at_current_difficulty for r in got] == [0, 1, 2, 3, 4]


def test_unused_features_are_pruned(spark):
    from lodestride.plans.catalogue import bandit_table

    rows = features.add_features(bandit_table(spark, str(DATA / "sf0.001")))
    plan = rows.select("user_id", "rolling_win_rate_3d")._jdf.queryExecution().optimizedPlan().toString()
    assert "playtime" not in plan and "fps" not in plan and "booster" not in plan


def test_estimators_of_equal_policies(spark):
    rng = np.random.default_rng(42)
    rows = [(int(i % 50), int(rng.integers(5)), float(rng.exponential(1000)), 0.2, 0.8) for i in range(1000)]
    df = spark.createDataFrame(rows, "user_id long, arm int, reward double, pi_old double, multiplier double")
    got, mean = ope.estimators(df).first(), np.mean([r[2] for r in rows])
    assert got.ips == pytest.approx(mean) and got.snips == pytest.approx(mean)
    assert ope.ess_diagnostics(df).first().ess == pytest.approx(1000)
    boot = {r.estimator: r for r in ope.bootstrap(df, replicates=300).collect()}
    assert boot["snips"].low < mean < boot["snips"].high and abs(boot["snips"].mean - mean) < 3 * boot["snips"].std
    assert ope.coverage(df.where("arm < 4")).first().min_count == 0
    checks = ope.input_checks(df.limit(1).withColumn("pi_old", F.lit(0.0))).first()
    assert checks.pi_old_not_positive == 1 and checks.pi_sum_off == 0


def test_records_round_trip(spark):
    rows = spark.createDataFrame([(42, date(2024, 1, 1), 0.25, 1.0, 3, 120.0, 0.88, 0.2), (43, date(2024, 1, 1), 0.0, None, 1, 0.0, 0.88, 0.5)],
                                 "user_id long, session_date date, coin_balance double, levels_started double, arm int, reward double, multiplier double, pi_old double")
    got = records.cb_adf_records(rows, ["coin_balance", "levels_started"]).orderBy("user_id")
    lines = values(got, "record")[0].split("\n")
    assert lines[0] == "shared |e coin_balance:0.250000 |s levels_started:1.000000  # uid:42"
    assert lines[1] == "|a arm:0 delta:-0.12 |c mult:0.88 feasible:1" and lines[4] == "3:-120.0000:0.200000 |a arm:3 delta:0.06 |c mult:0.88 feasible:1"
    assert len(lines) == 7 and lines[6] == ""
    back = records.parse_cb_adf(got).orderBy("uid").collect()
    assert [(r.arm, r.reward, r.propensity, r.uid) for r in back] == [(3, 120.0, 0.2, 42), (1, 0.0, 0.5, 43)]
    assert [records.namespace_of(n) for n in ("user_x", "ewma_level", "economy", "ewma_fps")] == ["u", "s", "f", "e"]


def test_reward_asof_takes_the_first_later_session(spark):
    day = lambda d: date(2024, 1, d)
    log = spark.createDataFrame([(1, day(3), 0, 1), (1, day(3), 1, 2), (2, day(3), 0, 1)], "user_id long, decision_date date, chosen_arm int, decided_at int")
    sessions = spark.createDataFrame([(1, day(3), 1.0), (1, day(5), 2.0), (1, day(6), 3.0), (2, day(2), 9.0)], "user_id long, session_date date, reward double")
    got = {r.user_id: r for r in decisions.reward_asof(log, sessions).collect()}
    assert (got[1].chosen_arm, got[1].reward_session_date, got[1].reward_amount) == (1, day(5), 2.0) and got[2].reward_amount is None


def test_upsert_and_sample_ratio(spark):
    old = spark.createDataFrame([(1, 0.5), (2, 0.6)], "user_id long, m double")
    new = spark.createDataFrame([(2, 0.7), (3, 0.8)], "user_id long, m double")
    assert sorted(map(tuple, decisions.upsert(old, new, ["user_id"]).collect())) == [(1, 0.5), (2, 0.7), (3, 0.8)]
    counts = spark.createDataFrame([(100, 900), (150, 850)], "n_treatment long, n_control long")
    assert values(decisions.sample_ratio_check(counts).orderBy("n_treatment"), "mismatch") == [False, True]


def test_cleaning(spark):
    df = spark.createDataFrame([(1, float("inf"), 1.0), (2, float("nan"), 2.0), (3, None, 3.0), (4, -1.5, 3.0)], "user_id long, x double, next_y double")
    assert values(cleaning.filled(df, ["x"]).orderBy("user_id"), "x") == [0.0, 0.0, 0.0, -1.5]
    assert cleaning.numeric_columns(df, exclude=("user_id",)) == ["x"]
    assert values(cleaning.minmax_scaled(df.where("user_id < 3"), df, ["next_y"]).orderBy("user_id"), "next_y") == [0.0, 1.0, 1.0, 1.0]
    split = cleaning.user_split(spark.range(2000).withColumnRenamed("id", "user_id"))
    shares = {r.split: r["count"] / 2000 for r in split.groupBy("split").count().collect()}
    assert abs(shares["train"] - 0.8) < 0.05


def test_files_and_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, date(2024, 1, 1), "a"), (2, date(2024, 1, 2), "b")], "user_id long, session_date date, v string")
    path = str(tmp_path / "t.parquet")
    writers.write_partitioned(df, path)
    writers.write_partitioned(df.where("user_id = 2").withColumn("v", F.lit("c")), path, mode="replace")
    assert sorted(values(readers.read_files(spark, path), "v")) == ["a", "c"]
    df.write.option("header", True).csv(str(tmp_path / "t.csv"))
    assert dict(readers.read_files(spark, str(tmp_path / "t.csv")).dtypes)["user_id"] == "string"
    assert readers.date_of("events_2024_01_31") == date(2024, 1, 31) and readers.date_of("events") is None
    assert readers.layered({"a": None, "b": 1}, {"a": 2, "b": 3}) == {"a": 2, "b": 1}
    assert writers.sink_partitions(10) == 1 and writers.sink_partitions(10**9) == 200
    assert writers.already_done(date(2024, 1, 2), date(2024, 1, 2)) and not writers.already_done(None, date(2024, 1, 2))
    out = tmp_path / "kv"
    out.mkdir()

    def put(rows):
        for k, v in rows:
            (out / k).write_text(v)

    writers.write_bulk(df, "user_id", "v", put, batch=1, prefix="u:", upper=True)
    assert {p.name: p.read_text() for p in out.iterdir()} == {"U:1": "a", "U:2": "b"}
    records_df = spark.createDataFrame([("shared |f a:1\n|a x\n",), ("shared |f a:2\n|a y\n",)], "record string")
    writers.write_records(records_df, str(tmp_path / "text"))
    assert readers.read_records(spark, str(tmp_path / "text")).count() == 2


def test_stream_equals_batch(spark, tmp_path):
    events = spark.read.schema(readers.EVENT_SCHEMA).parquet(str(DATA / "sf0.001/events.parquet"))
    events.repartition(3).write.parquet(str(tmp_path / "in"))
    batches = []
    stream = streaming.windowed_spend(streaming.event_stream(spark, str(tmp_path / "in"), 1), late="60 days")
    streaming.run_available(stream, str(tmp_path / "c"), lambda df, i: batches.append(df.toPandas()), mode="update")
    got = pd.concat(batches).groupby(["start", "event_type"])["n"].max()
    want = events.groupBy(F.to_date("ts").cast("timestamp").alias("start"), "event_type").count().toPandas().set_index(["start", "event_type"])["count"]
    assert got.to_dict() == want.to_dict()
    spans = streaming.sessions(events.withColumn("ts", F.col("ts").cast("timestamp")))
    assert spans.agg(F.sum("n")).first()[0] == 1000


def test_daily_counts_keep_null_keys(spark):
    """Distinct counts meet their own user and day, null ones too."""
    events = game.game_events(spark, str(DATA / "sf0.001"))
    some = events.where("event_id < 400").withColumn("user_id", F.expr("CASE WHEN event_id % 3 <> 0 THEN user_id END")).withColumn("session_date", F.expr("CASE WHEN event_id % 5 <> 0 THEN session_date END"))
    some = some.withColumn("session_id", F.expr("CASE WHEN event_id % 2 = 0 THEN session_id END"))
    frame = some.toPandas()
    frame["user_id"], frame["session_date"] = frame["user_id"].fillna(-1), frame["session_date"].map(lambda d: "none" if pd.isna(d) else d)
    on = frame["event_name"].isin(["levelStarted", "levelEnded", "levelOutOfSpace", "levelOutOfTime"])
    want = sorted((int(u), str(d), int(g["session_id"].nunique()), int(g.loc[on, "level_index"].nunique()) if on[g.index].any() else None) for (u, d), g in frame.groupby(["user_id", "session_date"]))
    days = daily.daily_features(some).select("user_id", "session_date", "daily_session_count", "distinct_levels_played").collect()
    got = sorted((-1 if r[0] is None else r[0], str(r[1] or "none"), r[2], r[3]) for r in days)
    assert len(want) > 50 and {-1, "none"} <= {k for w in want for k in w[:2]} and any(w[2] == 0 for w in want)
    assert got == want
    assert daily.daily_features(some.where("false")).count() == 0
