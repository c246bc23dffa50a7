"""Off-policy evaluation: estimators, diagnostics, bootstrap. Input rows have columns

arm (0 to 4), reward, pi_old, multiplier, user_id; the target policy is uniform over feasible arms
unless a ``pi`` array column is there. Q values are arm means, the global mean for unseen arms.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestride.config import ARMS, PROPENSITY_FLOOR, QUANTILE_ACCURACY, WEIGHT_CLIP
from lodestride.functions.arms import array_total, uniform_policy


def arm_mean_q(rows: DataFrame) -> DataFrame:
    """Mean reward of each of the five arms; the global mean where an arm has no row."""
    arms = rows.sparkSession.range(len(ARMS)).select(F.col("id").cast("int").alias("arm"))
    means = rows.groupBy(F.col("arm").cast("int").alias("arm")).agg(F.avg("reward").alias("q"), F.count("reward").alias("n"), F.sum("reward").alias("s"))
    joined = arms.join(means, "arm", "left").select("arm", "q", F.coalesce("n", F.lit(0)).alias("n"), "s")
    # Five rows become one and five again, so the global mean needs no second pass.
    whole = joined.agg(F.collect_list(F.struct("arm", "q", "n")).alias("arms"), F.try_divide(F.sum("s"), F.sum("n")).alias("mean"))
    return whole.select(F.explode("arms").alias("a"), "mean").select("a.arm", F.coalesce("a.q", "mean").alias("q"), "a.n")


def with_weights(rows: DataFrame, clip: float | None = WEIGHT_CLIP) -> DataFrame:
    """Rows with pi, the target probability of the arm taken, and its weight, clipped and not."""
    if "pi" not in rows.columns:
        rows = rows.withColumn("pi", uniform_policy(F.col("multiplier")))
    target = F.element_at("pi", F.col("arm").cast("int") + 1)
    w = target / F.col("pi_old")
    return rows.select("*", target.alias("pi_target"), w.alias("raw_w"), (F.least(w, F.lit(clip)) if clip else w).alias("w"))


def weighted(rows: DataFrame, clip: float | None = WEIGHT_CLIP) -> DataFrame:
    """As with_weights, with q of the arm and the expectation v of q under the target; q comes from a scalar subquery."""
    means = arm_mean_q(rows).agg(F.transform(F.array_sort(F.collect_list(F.struct("arm", "q"))), lambda x: x["q"]).alias("q"))
    ready = with_weights(rows, clip).withColumn("__q", means.scalar())
    ready = ready.withColumn("q_obs", F.element_at("__q", F.col("arm").cast("int") + 1))
    return ready.withColumn("v", array_total(F.zip_with("pi", "__q", lambda p, x: p * x))).drop("__q")


def estimators(rows: DataFrame, clip: float | None = WEIGHT_CLIP, by: str | None = None) -> DataFrame:
    """IPS, SNIPS and DR, in one pass over the rows; per group with ``by``.

    All that the estimators need are sums for each arm and target vector (160 for the uniform target), so q and v are found
    from these, which become one row.
    """
    ready = with_weights(rows, clip)
    sums = {"n": F.count(F.lit(1)), "nr": F.count("reward"), "r": F.sum("reward"), "w": F.sum("w"), "wr": F.sum(F.col("w") * F.col("reward"))}
    key = F.col(by) if by else F.lit(0)
    cells = ready.groupBy(key.alias("by"), F.col("arm").cast("int").alias("arm"), "pi").agg(*[c.alias(k) for k, c in sums.items()])
    whole = cells.agg(F.collect_list(F.struct("by", "arm", "pi", *sums)).alias("cells"))
    total = lambda field, arm=None: F.aggregate(F.filter("cells", lambda c: c["arm"] == arm) if arm is not None else F.col("cells"), F.lit(0.0), lambda s, c: s + F.coalesce(c[field].cast("double"), F.lit(0.0)))
    q = F.array(*[F.coalesce(F.try_divide(total("r", i), total("nr", i)), F.try_divide(total("r"), total("nr"))) for i in range(len(ARMS))])
    flat = whole.withColumn("q", q).select("q", F.explode("cells").alias("c")).select("q", "c.*")
    v = array_total(F.zip_with("pi", "q", lambda p, x: p * x))
    dr = F.col("n") * v + F.col("wr") - F.element_at("q", F.col("arm") + 1) * F.col("w")
    out = flat.withColumn("dr", dr).groupBy("by").agg(
        F.sum("n").alias("n"),
        F.try_divide(F.sum("wr"), F.sum("nr")).alias("ips"),
        F.try_divide(F.sum("wr"), F.sum("w")).alias("snips"),
        F.try_divide(F.sum("dr"), F.sum("n")).alias("dr"),
        F.try_divide(F.sum("r"), F.sum("nr")).alias("baseline"),
    )
    return out.withColumnRenamed("by", by) if by else out.drop("by")


def ess_diagnostics(rows: DataFrame) -> DataFrame:
    """Effective sample size, weight quantiles (rank error of 1 in 10,000), clip rates at 10, 20, 50 and 100, counts over 50 and 100."""
    ready = with_weights(rows, None)
    w = F.col("raw_w")
    ess = F.sum(w) * F.sum(w) / F.sum(w * w)
    return ready.agg(
        F.count(F.lit(1)).alias("n"),
        ess.alias("ess"),
        (ess / F.count(F.lit(1))).alias("ess_ratio"),
        *[F.percentile_approx("raw_w", F.lit(p / 100), F.lit(QUANTILE_ACCURACY)).alias(f"w_p{p}") for p in (5, 50, 90, 99)],
        *[F.avg((w > c).cast("double")).alias(f"clip_rate_{c}") for c in (10, 20, 50, 100)],
        F.max(w).alias("w_max"),
        F.sum((w > 50).cast("long")).alias("n_over_50"),
        F.sum((w > 100).cast("long")).alias("n_over_100"),
    )


def dr_mean_q(rows: DataFrame) -> DataFrame:
    """Simplified DR: target 1/5, no expectation term; weight 0 where pi_old is NaN or at most the floor."""
    ready = weighted(rows, None)
    bad = F.col("pi_old").isNull() | F.isnan("pi_old") | (F.col("pi_old") <= PROPENSITY_FLOOR)
    w = F.when(bad, 0.0).otherwise((1.0 / len(ARMS)) / F.col("pi_old"))
    return ready.agg(F.avg(F.col("q_obs") + w * (F.col("reward") - F.col("q_obs"))).alias("dr"), F.count(F.lit(1)).alias("n"))


def ips_policy(rows: DataFrame) -> DataFrame:
    """IPS of the target policy with propensities floored."""
    ready = with_weights(rows, None)
    return ready.agg(F.avg(F.col("pi_target") / F.greatest("pi_old", F.lit(PROPENSITY_FLOOR)) * F.col("reward")).alias("ips"), F.count(F.lit(1)).alias("n"))


def input_checks(rows: DataFrame) -> DataFrame:
    """Number of violations of each input rule."""
    rows = rows if "pi" in rows.columns else rows.withColumn("pi", uniform_policy(F.col("multiplier")))
    count = lambda c, n: F.sum(F.coalesce(c, F.lit(True)).cast("long")).alias(n)
    return rows.agg(
        F.count(F.lit(1)).alias("n"),
        count(F.col("pi_old") <= 0, "pi_old_not_positive"),
        count(F.abs(array_total(F.col("pi")) - 1) > 1e-6, "pi_sum_off"),
        count(~F.col("arm").between(0, len(ARMS) - 1), "unknown_arm"),
        count(F.col("reward").isNull(), "reward_missing"),
    )


def uid_rate(parsed: DataFrame) -> DataFrame:
    """Share of parsed records with a user id, and how many lack one."""
    missing = F.sum(F.col("uid").isNull().cast("long"))
    n = F.count(F.lit(1))
    return parsed.agg(n.alias("n"), F.coalesce(F.try_divide(n - missing, n), F.lit(0.0)).alias("success_rate"), F.coalesce(missing, F.lit(0)).alias("missing"))


def coverage(rows: DataFrame) -> DataFrame:
    """Arm counts and shares with entropy, population deviation, balance and rare arms; arms without rows stay."""
    arms = rows.sparkSession.range(len(ARMS)).select(F.col("id").cast("int").alias("arm"))
    counts = arms.join(rows.groupBy(F.col("arm").cast("int").alias("arm")).count(), "arm", "left").select("arm", F.coalesce("count", F.lit(0)).alias("n"))
    share = F.col("n") / F.col("total")
    with_total = counts.groupBy().agg(F.collect_list(F.struct("arm", "n")).alias("arms"), F.sum("n").alias("total"))
    flat = with_total.select(F.explode("arms").alias("a"), "total").select("a.arm", "a.n", "total")
    entropy = F.sum(F.when(F.col("n") > 0, -share * F.log(share)).otherwise(0.0))
    return flat.groupBy().agg(
        F.max("total").alias("total"),
        F.min("n").alias("min_count"),
        F.max("n").alias("max_count"),
        F.stddev_pop("n").alias("std_count"),
        entropy.alias("entropy"),
        (entropy / F.log(F.lit(float(len(ARMS))))).alias("balance_index"),
        F.sum((share < 0.01).cast("long")).alias("rare_arms"),
    )


def scale_factor(dr: float, loss: float) -> float:
    """Factor from a learner's (negative) loss to the scale of rewards."""
    if loss >= 0:
        raise ValueError(f"the loss must be negative, not {loss}")
    return dr / -loss


# Bootstrap: weights are Poisson(1), drawn from 16 bits of an md5, eight replicates a digest.
DRAWS, LEVELS = 8, 65536


def poisson_steps() -> list[float]:
    """Distribution function of Poisson(1), as far as 16 bits tell it from 1."""
    steps, p, total = [], 0.36787944117144233, 0.0
    for k in range(9):
        total += p
        steps.append(total)
        p /= k + 1
    return steps


UNITS = 2048


def resampled_unit(user: Column, units: int | None = UNITS) -> Column:
    """What the bootstrap draws: one of ``units`` groups of users by a hash, or (None) each user."""
    if units is None:
        return user.cast("string")
    return F.pmod(F.conv(F.substring(F.md5(F.concat(user.cast("string"), F.lit("_unit"))), 1, 8), 16, 10).cast("long"), F.lit(units)).cast("string")


def replicate_sums(rows: DataFrame, replicates: int, clip: float | None, seed: int, by: str | None = None, units: int | None = UNITS) -> DataFrame:
    """(by, replicate, n, sw, swr, sdr): weighted sums of per-unit statistics; a replicate's weights depend on unit, replicate and seed alone.

    All rows of a user are in one unit, so clusters stay whole. With a fixed number of units the sums combine where the rows are and
    what is drawn is units x replicates, however many users there are. The residuals of a ratio add up to nothing, so sums over
    groups of users have the variance of the users' own in expectation; grouping adds an error of about sqrt(1 / (2 units)) to an interval's width,
    1.6 %, as much as 1,000 replicates do.
    """
    ready = weighted(rows, clip)
    per_unit = ready.groupBy(*([by] if by else []), resampled_unit(F.col("user_id"), units).alias("unit")).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("w").alias("sw"),
        F.sum(F.col("w") * F.col("reward")).alias("swr"),
        F.sum(F.col("v") + F.col("w") * (F.col("reward") - F.col("q_obs"))).alias("sdr"),
    )
    if units is None:  # few bytes but much work a user, so all cores share it; replicates are summed where they are drawn
        per_unit = per_unit.repartition(rows.sparkSession.sparkContext.defaultParallelism, "unit")
    digest = F.md5(F.concat_ws("_", F.col("unit"), F.col("block").cast("string"), F.lit(str(seed))))
    drawn = per_unit.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(-(-replicates // DRAWS) - 1)))).withColumn("digest", digest)
    drawn = drawn.withColumn("draw", F.explode(F.sequence(F.lit(0), F.lit(DRAWS - 1)))).withColumn("replicate", F.col("block") * DRAWS + F.col("draw"))
    # u = (h + 0.5) / LEVELS of four hex digits h is at least a step from some h on; digits of one length compare as text.
    digits, least = F.substring(F.col("digest"), F.col("draw") * 4 + 1, F.lit(4)), [math.ceil(x * LEVELS - 0.5) for x in poisson_steps()]
    k = sum(((F.col("h") >= f"{t:04x}").cast("int") for t in least if t < LEVELS), F.lit(0))
    drawn = drawn.where(F.col("replicate") < replicates).withColumn("h", digits).withColumn("k", k)
    return drawn.groupBy(*([by] if by else []), "replicate").agg(*[F.sum(F.col("k") * F.col(c)).alias(c) for c in ("n", "sw", "swr", "sdr")])


def bootstrap(rows: DataFrame, replicates: int = 1000, clip: float | None = WEIGHT_CLIP, seed: int = 42, alpha: float = 0.05, units: int | None = UNITS) -> DataFrame:
    """Cluster bootstrap by groups of users (or, with ``units`` None, by user): IPS, SNIPS and DR with mean, population deviation and percentile bounds."""
    each = replicate_sums(rows, replicates, clip, seed, units=units)
    of = {"ips": F.try_divide("swr", "n"), "snips": F.try_divide("swr", "sw"), "dr": F.try_divide("sdr", "n")}
    long = each.select(F.explode(F.array(*[F.struct(F.lit(e).alias("estimator"), x.alias("x")) for e, x in of.items()])).alias("r"))
    return long.groupBy("r.estimator").agg(
        F.avg("r.x").alias("mean"),
        F.stddev_pop("r.x").alias("std"),
        F.expr(f"percentile(r.x, {alpha / 2})").alias("low"),
        F.expr(f"percentile(r.x, {1 - alpha / 2})").alias("high"),
        F.count("r.x").alias("replicates"),
    )


def lift_interval(rows: DataFrame, replicates: int = 10_000, clip: float | None = WEIGHT_CLIP, seed: int = 42, alpha: float = 0.05, units: int | None = UNITS) -> DataFrame:
    """Percentile bounds of DR of treatment less DR of control (column grp), users drawn with repeats in each group."""
    each = replicate_sums(rows, replicates, clip, seed, "grp", units)
    of = lambda g: F.max(F.when(F.col("grp") == g, F.try_divide("sdr", "n")))
    lift = each.groupBy("replicate").agg((of("treatment") - of("control")).alias("x"))
    return lift.agg(F.expr(f"percentile(x, {alpha / 2})").alias("ci_low"), F.expr(f"percentile(x, {1 - alpha / 2})").alias("ci_high"), F.count("x").alias("replicates"))
