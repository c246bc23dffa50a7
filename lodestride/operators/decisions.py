"""Decision logs, reward attribution, upserts, experiments and gates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestride.config import ARMS, DEPLOY_LOSS_INCREASE, SRM_CRITICAL
from lodestride.functions.arms import md5_bucket


def latest_per_key(rows: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row per key: the last by ``order``. An aggregate, so it combines before the shuffle."""
    rest = [c for c in rows.columns if c not in keys]
    best = rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("__best"))
    return best.select(*keys, *[F.col(f"__best.`{c}`").alias(c) for c in rest]).select(*rows.columns)


def dedupe_decisions(decisions: DataFrame) -> DataFrame:
    """Latest decision of each user and date."""
    return latest_per_key(decisions, ["user_id", "decision_date"], [F.col("decided_at")])


def reward_asof(decisions: DataFrame, sessions: DataFrame) -> DataFrame:
    """First session strictly after each decision, with its reward; latest decision of a day first.

    A forward as-of join in one sorted pass per user: both sides are tagged and unioned, and each decision takes the
    nearest later session, so no pair of rows is made.
    """
    decided = dedupe_decisions(decisions)
    left = decided.select("user_id", F.col("decision_date").alias("day"), F.lit(None).cast("struct<session_date:date,reward:double>").alias("s"), F.struct(*decided.columns).alias("d"))
    right = sessions.select("user_id", F.col("session_date").alias("day"), F.struct("session_date", F.col("reward").cast("double").alias("reward")).alias("s"), F.lit(None).cast(left.schema["d"].dataType).alias("d"))
    after = Window.partitionBy("user_id").orderBy(F.unix_date("day")).rangeBetween(1, Window.unboundedFollowing)
    joined = left.unionByName(right).withColumn("next", F.first("s", ignorenulls=True).over(after)).where("d IS NOT NULL")
    return joined.select("d.*", F.col("next.session_date").alias("reward_session_date"), F.col("next.reward").alias("reward_amount"))


def upsert(target: DataFrame, updates: DataFrame, keys: list[str]) -> DataFrame:
    """New state of ``target``: rows of ``updates`` replace those with equal keys, the rest are added."""
    kept = target.join(updates.select(*keys).distinct(), keys, "left_anti")
    return kept.unionByName(updates.select(*target.columns))


def apply_rewards(decisions: DataFrame, rewards: DataFrame) -> DataFrame:
    """Decisions with pending rewards filled in where they are known; others stay."""
    known = rewards.select("user_id", "decision_date", F.col("reward_amount").alias("__r"))
    joined = decisions.join(known, ["user_id", "decision_date"], "left")
    return joined.withColumn("reward_amount", F.coalesce("reward_amount", "__r")).drop("__r")


def assign_groups(users: DataFrame, percent: int = 10) -> DataFrame:
    bucket = md5_bucket(F.col("user_id"))
    return users.withColumn("bucket", bucket).withColumn("grp", F.when(F.col("bucket") < percent, "treatment").otherwise("control"))


def sample_ratio_check(counts: DataFrame, expected: float = 0.1) -> DataFrame:
    """Chi-square (one degree of freedom) of n_treatment and n_control against the expected share."""
    n = F.col("n_treatment") + F.col("n_control")
    chi2 = F.pow(F.col("n_treatment") - n * expected, 2) / (n * expected) + F.pow(F.col("n_control") - n * (1 - expected), 2) / (n * (1 - expected))
    return counts.withColumn("chi2", chi2).withColumn("mismatch", F.col("chi2") > SRM_CRITICAL)


def lift(estimates: DataFrame) -> DataFrame:
    """Absolute and relative lift from a row per group (grp, dr)."""
    of = lambda g: F.max(F.when(F.col("grp") == g, F.col("dr")))
    row = estimates.agg(of("treatment").alias("dr_treatment"), of("control").alias("dr_control"))
    row = row.withColumn("lift", F.col("dr_treatment") - F.col("dr_control"))
    return row.withColumn("lift_pct", F.when(F.abs("dr_control") > 1e-12, F.col("lift") / F.abs("dr_control")).otherwise(0.0))


def sequential_decision(rows: DataFrame, min_lift: float = 0.05, min_days: int = 7, rollback: float = -0.05) -> DataFrame:
    """rollback, advance, stop or continue from days, lift_pct and the bounds of its interval (of the relative lift, too)."""
    enough, lifted = F.col("days") >= min_days, F.coalesce(F.col("lift_pct") > min_lift, F.lit(False))
    verdict = (
        F.when(F.col("ci_high") < rollback, "rollback")
        .when(enough & lifted & (F.col("ci_low") > 0), "advance")
        .when(enough & ~lifted, "stop")
        .otherwise("continue")
    )
    return rows.withColumn("decision", verdict)


def progressive_loss(rows: DataFrame) -> DataFrame:
    """Mean absolute error of each day's rewards under what all days before it say of their arms: session_date, n, loss.

    The prediction is the mean reward of the arm on earlier days, 0 for an arm without one. Only sums by day and arm are kept for it.
    """
    sums = rows.groupBy("session_date", "arm").agg(F.sum("reward").alias("s"), F.count("reward").alias("k"))
    days = sums.select("session_date").distinct().select("session_date", F.explode(F.array(*[F.lit(i) for i in range(len(ARMS))])).alias("arm"))
    dense = days.join(sums, ["session_date", "arm"], "left")  # five rows a day
    before = Window.partitionBy("arm").orderBy("session_date").rowsBetween(Window.unboundedPreceding, -1)
    known = dense.select("session_date", "arm", F.coalesce(F.try_divide(F.sum("s").over(before), F.sum("k").over(before)), F.lit(0.0)).alias("predicted"))
    scored = rows.where("reward IS NOT NULL").join(F.broadcast(known), ["session_date", "arm"])
    return scored.groupBy("session_date").agg(F.count(F.lit(1)).alias("n"), F.avg(F.abs(F.col("reward") - F.col("predicted"))).alias("loss"))


def deploy_gate(runs: DataFrame, threshold: float = DEPLOY_LOSS_INCREASE) -> DataFrame:
    """Each run (model_id, run_at, loss) against the last deployed one: a rise of the loss over ``threshold`` blocks it.

    Without a deployed run, or after one whose loss wasn't finite, a run is deployed; a run without a loss is blocked. A model's runs are folded in order, as each gate depends on the one before.
    """
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    ordered = runs.groupBy("model_id").agg(F.array_sort(F.collect_list(F.struct("run_at", "loss"))).alias("runs"))
    empty = F.array().cast(f"array<struct<run_at:{runs.schema['run_at'].dataType.simpleString()},loss:double,previous_loss:double,deploy:boolean>>")

    def step(s, run):
        loss, last = run["loss"].cast("double"), s["last"]
        risen = loss - last > threshold * F.abs(last)
        deploy = loss.isNotNull() & F.coalesce(~finite(last) | (finite(loss) & ~risen), F.lit(True))
        row = F.struct(run["run_at"].alias("run_at"), loss.alias("loss"), last.alias("previous_loss"), deploy.alias("deploy"))
        return F.struct(F.when(deploy, loss).otherwise(last).alias("last"), F.concat(s["out"], F.array(row)).alias("out"))

    start = F.struct(F.lit(None).cast("double").alias("last"), empty.alias("out"))
    return ordered.select("model_id", F.explode(F.aggregate("runs", start, step)["out"]).alias("r")).select("model_id", "r.*")
