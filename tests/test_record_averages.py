"""Averages in records end on the same digit as the closed form of the SQL, halves included."""

import datetime as dt
import math
import random

from lodestride.operators import ewma
from lodestride.plans import catalogue


def histories(spark, users=80, days=30):
    rng = random.Random(5)
    values = {u: [rng.choice([0.0, round(rng.expovariate(1 / 40), 2)]) for _ in range(days)] for u in range(users)}
    rows = [(u, dt.date(2024, 1, 1) + dt.timedelta(n), x) for u, xs in values.items() for n, x in enumerate(xs)]
    return values, spark.createDataFrame(rows, "user_id long, session_date date, daily_spend_coins double")


def closed(xs):
    """The SQL's sum over earlier rows, in the order in which DuckDB adds them: the latest first."""
    total = 0.0
    for i in reversed(range(len(xs))):
        total += (1 if i == 0 else 0.3) * math.pow(0.7, len(xs) - 1 - i) * xs[i]
    return total


def test_averages_have_the_bits_of_the_closed_form(spark):
    values, rows = histories(spark)
    got = {(r[0], (r[1] - dt.date(2024, 1, 1)).days): r[3] for r in ewma.add_ewma(rows, [], pairs=[("daily_spend_coins", 0.3)]).collect()}
    assert got == {(u, n): closed(xs[:n]) for u, xs in values.items() for n in range(len(xs))}


def test_record_table_rounds_as_the_sql(spark, monkeypatch):
    values, rows = histories(spark)
    monkeypatch.setattr(catalogue, "bandit_table", lambda spark, d: rows)
    got = {(r[0], (r[1] - dt.date(2024, 1, 1)).days): r[3] for r in catalogue._record_table(spark, "").collect()}
    half_up = lambda y: (math.floor(y) + (y - math.floor(y) >= 0.5)) / 1e6
    assert got == {(u, n): half_up(closed(xs[:n]) * 1e6) for u, xs in values.items() for n in range(len(xs))}
