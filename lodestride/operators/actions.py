"""Logged actions, arm labels, rewards: the decision dataset."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, WindowSpec
from pyspark.sql import functions as F


# Label bands of the rounded change of the multiplier.
BANDS = (("Same", 0.0, 0.0), ("Harder", 0.05, 0.07), ("Easier", -0.07, -0.05), ("Harderer", 0.11, 0.13), ("Easierer", -0.13, -0.11))
ACTION = """CASE WHEN multiplier >= 1.25 AND next_multiplier > multiplier THEN 0
  WHEN multiplier <= 0.5 AND next_multiplier < multiplier THEN 0
  ELSE round(next_multiplier - multiplier, 2) END"""
LABEL = "CASE " + " ".join(f"WHEN action BETWEEN {a} AND {b} THEN '{n}'" for n, a, b in BANDS) + " END"


def _by_user() -> WindowSpec:
    return Window.partitionBy("user_id").orderBy("session_date")


def multi_day_users(events: DataFrame) -> DataFrame:
    """Events of users with at least two distinct days."""
    users = events.select("user_id", "session_date").distinct().groupBy("user_id").count().where("count >= 2")
    return events.join(users, "user_id", "left_semi")


def logged_actions(events: DataFrame) -> DataFrame:
    """First unassisted level start with a multiplier, per user and day."""
    starts = events.where("event_name = 'levelStarted' AND multiplier IS NOT NULL AND assist = 0")
    return starts.groupBy("user_id", "session_date").agg(F.min_by("multiplier", F.struct("ts", "event_id")).alias("multiplier"))


def assign_arms(logged: DataFrame, strict_calendar: bool = False) -> DataFrame:
    """Arm label of the change to the user's next logged row; rows without a label go.

    ``strict_calendar``: the next row counts only if it is of the next day.
    """
    following = F.lead("multiplier").over(_by_user())
    if strict_calendar:
        following = F.when(F.datediff(F.lead("session_date").over(_by_user()), "session_date") == 1, following)
    rows = logged.withColumn("next_multiplier", following).withColumn("action", F.expr(ACTION).cast("double"))
    return rows.withColumn("difficulty_arm", F.expr(LABEL)).where("difficulty_arm IS NOT NULL")


def assign_arms_for_inference(logged: DataFrame) -> DataFrame:
    """All rows are kept; those without a next row have action 0 and arm "Inference"."""
    rows = logged.withColumn("following", F.lead("multiplier").over(_by_user())).withColumn("next_multiplier", F.coalesce("following", "multiplier"))
    rows = rows.withColumn("action", F.when(F.col("following").isNull(), 0.0).otherwise(F.expr(ACTION).cast("double")))
    label = F.when(F.col("following").isNull(), "Inference").otherwise(F.expr(LABEL))
    return rows.withColumn("difficulty_arm", label).drop("following")


def bandit_dataset(daily: DataFrame, arms: DataFrame, inference: bool = False) -> DataFrame:
    """Features, action and next reward; "next" is the user's next labelled row."""
    rows = daily.join(
        arms.select("user_id", "session_date", F.col("multiplier").alias("current_effectivelevelmultiplier"), "action", F.col("next_multiplier").alias("next_effectivelevelmultiplier"), "difficulty_arm"),
        ["user_id", "session_date"],
    )
    rows = rows.select(
        "*",
        F.lead("current_exchangespentamountcoins").over(_by_user()).alias("next_day_reward"),
        F.lag("action", 1, 0.0).over(_by_user()).alias("previous_day_action"),
        F.coalesce(F.lag("current_effectivelevelmultiplier").over(_by_user()), "current_effectivelevelmultiplier").alias("previous_day_multiplier"),
    )
    return rows if inference else rows.where("next_day_reward IS NOT NULL")
