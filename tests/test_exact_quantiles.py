"""Quantiles beyond the number of values that sketches keep as they are."""

import datetime as dt
import math
import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from lodestride.operators import cleaning, quantiles, sketches
from lodestride.plans import catalogue

N, PS = 40_000, [0.1, 0.5, 0.9, 0.999]


def disc(values, p):
    return sorted(values)[max(1, math.ceil(len(values) * Fraction(str(p)))) - 1]


@pytest.fixture(scope="module")
def table(spark):
    rng = random.Random(3)
    rows = [(n, dt.date(2024, 1, 5) + dt.timedelta(n % 20), rng.randrange(86_400), rng.choice([None, 0.0, rng.expovariate(1 / 50)])) for n in range(N)]
    rng.shuffle(rows)
    return rows, spark.createDataFrame(rows, "user_id long, session_date date, daily_play_duration_seconds long, daily_spend_coins double").repartition(8, "user_id").cache()


@pytest.fixture(scope="module")
def want(table):
    values = {"daily_play_duration_seconds": [r[2] for r in table[0]], "daily_spend_coins": [r[3] for r in table[0] if r[3] is not None]}
    return {(c, len(v), p): disc(v, p) for c, v in values.items() for p in PS}


def found(df):
    return {(r["name"], r["n"], r["p"]): r["value"] for r in df.collect()}


@pytest.mark.parametrize("cuts", [None, "array(-1D, 0D)", "array(1e9D)"])  # the last two shut nothing in
def test_exact_whatever_the_cuts(spark, table, want, cuts):
    columns = list(catalogue.SKETCHED)
    given = cuts and spark.createDataFrame([(c,) for c in columns], "name string").withColumn("cuts", F.expr(cuts))
    assert found(quantiles.exact_quantiles(table[1], columns, PS, given or None)) == want
    assert found(quantiles.exact_quantiles(table[1].where("false"), columns, PS)) == {}


def test_global_thresholds(spark, table, want, monkeypatch):
    monkeypatch.setattr(catalogue, "bandit_table", lambda spark, d: table[1])
    of = {(c, p): v for (c, _, p), v in want.items()}
    assert catalogue.global_thresholds(spark, "").collect() == [(of["daily_play_duration_seconds", 0.5], round(of["daily_spend_coins", 0.9], 4))]


def test_sketched_days_are_settled_by_their_rows(spark, table, want):
    columns = list(catalogue.SKETCHED)
    days = sketches.daily_sketches(table[1], columns)
    assert found(sketches.settled(table[1], days, columns, PS, dt.date(2024, 1, 5), dt.date(2024, 1, 25))) == want


def test_winsorized_at_the_exact_quantile(table):
    values = [r[3] for r in table[0] if r[3] is not None]
    assert cleaning.winsorized(table[1], "daily_spend_coins").agg(F.max("daily_spend_coins")).head()[0] == disc(values, 0.999)
