"""Arm and multiplier expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lodestride.config import ARMS, DELTAS, EPS, HIGH, LOW


def arm_array() -> Column:
    return F.array(*[F.lit(a) for a in ARMS])


def arm_index(arm: Column) -> Column:
    """0 to 4; null for an unknown name."""
    return F.nullif(F.array_position(arm_array(), arm), F.lit(0)) - 1


def feasible_flags(multiplier: Column) -> Column:
    """Array of 0/1: is the next multiplier inside the closed bounds; all 0 for null."""
    flag = lambda d: F.when((multiplier + d >= LOW - EPS) & (multiplier + d <= HIGH + EPS), 1.0).otherwise(0.0)
    return F.array(*[flag(d) for d in DELTAS])


def array_total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda a, x: a + x)


def normalized(values: Column, fallback: Column) -> Column:
    """``values`` scaled to sum 1; ``fallback`` where they sum to 0."""
    total = array_total(values)
    return F.when(total > 0, F.transform(values, lambda x: x / total)).otherwise(fallback)


def uniform_policy(multiplier: Column) -> Column:
    """Even over the feasible arms; even over all where none is."""
    return normalized(feasible_flags(multiplier), F.array(*[F.lit(1.0 / len(ARMS))] * len(ARMS)))


def next_multiplier(multiplier: Column, index: Column) -> Column:
    """Multiplier after the arm; the current one where that would leave the bounds."""
    moved = multiplier + F.element_at(F.array(*[F.lit(d) for d in DELTAS]), index.cast("int") + 1)
    return F.when((moved >= LOW - EPS) & (moved <= HIGH + EPS), moved).otherwise(multiplier)


def propensity_vector(multiplier: Column, chosen: Column, logged: Column) -> Column:
    """Logged probability on the chosen arm, the rest even over other feasible arms.

    Infeasible arms get 0, then the vector is normalized; uniform over feasible arms where the
    logged probability or the arm is missing or nothing is left.
    """
    feasible = feasible_flags(multiplier)
    others = array_total(feasible) - F.coalesce(F.element_at(feasible, chosen.cast("int") + 1), F.lit(0.0))
    rest = F.when((others > 0) & (logged < 1), (1 - logged) / others).otherwise(0.0)
    mixed = F.transform(feasible, lambda f, i: F.when(i == chosen, logged * f).otherwise(rest * f))
    uniform = uniform_policy(multiplier)
    return F.when(logged.isNotNull() & chosen.isNotNull(), normalized(mixed, uniform)).otherwise(uniform)


def inverse_cdf(probabilities: Column, u: Column) -> Column:
    """First index whose cumulated probability exceeds ``u`` in [0, 1); the last arm for rounding leftovers."""
    cumulated = F.transform(F.sequence(F.lit(1), F.size(probabilities)), lambda n: array_total(F.slice(probabilities, 1, n)))
    return F.least(F.size(F.filter(cumulated, lambda c: c <= u)), F.size(probabilities) - 1)


def md5_bucket(value: Column) -> Column:
    """md5 of the text as a number, modulo 100: 2^64 is 16 modulo 100."""
    digest = F.md5(value.cast("string"))
    high = F.conv(F.substring(digest, 1, 16), 16, 10).cast("decimal(20,0)") % 100
    low = F.conv(F.substring(digest, 17, 16), 16, 10).cast("decimal(20,0)") % 100
    return ((high * 16 + low) % 100).cast("int")


def uniform_of(text: Column) -> Column:
    """A number from 0 to below 1 by a hash of ``text``: 52 bits, so an arm of any probability that a double can tell from 0 is drawn in its share."""
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("long") / F.lit(float(1 << 52))
