"""Every query against its SQL twin on the smallest tables."""

import datetime
import math

import duckdb
import pandas as pd
import pytest

from lodestride.plans import ORACLES, QUERIES, catalogue  # noqa: F401
from tests.conftest import DATA

SF = DATA / "sf0.001"
TABLES = "region nation customer supplier part orders lineitem events".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def plain(v):
    if v is None or v is pd.NA or v is pd.NaT or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, str | datetime.date):
        return str(v)
    return round(float(v), 5) + 0.0


def rows(frame):
    return sorted((tuple(map(plain, r)) for r in frame[sorted(frame.columns)].itertuples(index=False)), key=str)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    got = QUERIES[name](spark, str(SF)).toPandas()
    if name in ORACLES:
        want = duck.execute(ORACLES[name]).df()
        assert sorted(got.columns) == sorted(want.columns)
        assert rows(got) == rows(want)


@pytest.mark.parametrize("name", ["ewma_features", "difficulty_trajectory", "ope_by_fold", "cb_adf_record", "reward_asof"])
def test_no_python_in_plans(spark, name):
    plan = QUERIES[name](spark, str(SF))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "InArrow" not in plan and "InPandas" not in plan


# Their schema or model depends on the data.
READ_WHILE_PLANNED = {"search_trials", "online_losses", "online_gate", "online_policy", "order_importances", "reward_stream", "ewma_incremental", "ewma_incremental_check", "merge_multipliers", "merge_rewards", "delta_snapshot", "one_hot", "drop_dead_columns", "forest_importances", "logistic_ranking", "arm_importances", "arm_importances_boosted", "logged_propensities", "balanced_propensities", "forest_propensities", "ope_with_reward_models"}


def test_planning_runs_no_job(spark):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("planning", "planning")
    for name in sorted(set(QUERIES) - READ_WHILE_PLANNED):
        QUERIES[name](spark, str(SF))
        # Reading the footers for a schema is a job of its own, one stage of one task.
        for job in tracker.getJobIdsForGroup("planning"):
            info = tracker.getJobInfo(job)
            assert info is None or len(info.stageIds) == 1, name
    spark.sparkContext.setJobGroup("rest", "rest")
