"""User-day aggregates: every metric in one groupBy, from a specification table.

Each entry is an aggregate in SQL; the three metric families of the domain (basic, level and
economy) need no joins among them, for conditions sit inside the aggregates. Exact distinct counts would multiply every row of that
aggregation by their number and key it by their values, so each has a narrow one of its own: distinct (user, day, value)
combine before they move, spread over values, so that a user-day with very many is no single task's, and the counts
join on the day, which both sides are already dealt by. A count that nobody reads goes with its join, as the day is a key of it. On days without a level event,
level metrics are null, but for the counts that are filled with 0 at the end.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestride.sources.game import LEVEL_EVENTS

MEASURES = {"mean": "avg", "std": "stddev_samp", "max": "max", "min": "min"}
BOOSTERS = ("undo", "extrabox", "hammer", "joker", "prejoker", "supersuit")


# Metrics that count distinct values are no part of the one aggregation (count_distinct).
DISTINCT = "distinct"
COUNTED = {"daily_session_count": "session_id", "distinct_levels_played": f"CASE WHEN {LEVEL_EVENTS} THEN level_index END"}


def _sum0(value: str, when: str = "TRUE") -> str:
    return f"CAST(sum(CASE WHEN {when} THEN coalesce({value}, 0) ELSE 0 END) AS DOUBLE)"


def _measure(name: str, value: str, when: str) -> str:
    return f"CAST({MEASURES[name]}(CASE WHEN {when} THEN {value} END) AS DOUBLE)"


def _count(when: str) -> str:
    return f"CAST(sum(CASE WHEN {when} THEN 1 ELSE 0 END) AS BIGINT)"


def basic() -> dict[str, str]:
    out = {}
    for money, kind, aliases in (
        ("real", "RealCurrency", ("current_spend", "daily_spend_real_sum", "daily_spend_real")),
        ("coins", "VirtualCurrency", ("current_exchangespentamountcoins", "daily_spend_coins_sum", "daily_spend_coins")),
    ):
        when = f"spend_type = '{kind}'"
        out |= dict.fromkeys(aliases, _sum0("spend_amount", when))
        out |= {f"daily_spend_{money}_{m}": _measure(m, "spend_amount", when) for m in MEASURES}
    out |= {"day_start_ts": "min(ts)", "day_end_ts": "max(ts)"}
    for name, value in (("user_segment", "user_segment"), ("platform", "platform"), ("user_level_start", "user_level")):
        out[name] = f"min_by({value}, ts) FILTER (WHERE {value} IS NOT NULL)"
    out["user_level_end"] = "max_by(user_level, ts) FILTER (WHERE user_level IS NOT NULL)"
    return out | {"daily_event_count": "count(*)", "daily_session_count": DISTINCT}


def level() -> dict[str, str]:
    on, end = LEVEL_EVENTS, "event_name IN ('levelEnded', 'levelOutOfSpace', 'levelOutOfTime')"
    out = {
        "level_event_count": _count(on),
        "levels_started": _count("event_name = 'levelStarted'"),
        "levels_completed": _count(f"{end} AND level_result = 'Victory'"),
        "levels_failed": _count(f"{end} AND level_result IN ('Defeat', 'Abort')"),
        "total_level_attempts": _sum0("attempts", on),
        "avg_level_attempts": _measure("mean", "attempts", on),
        "distinct_levels_played": DISTINCT,
        "total_level_duration": _sum0("duration", on),
        "avg_level_duration": _measure("mean", "duration", on),
        "avg_time_remaining": _measure("mean", "time_remaining", on),
        "avg_rank_easing": _measure("mean", "rank_easing", on),
        "avg_effective_multiplier": _measure("mean", "multiplier", on),
        "avg_fps": _measure("mean", "fps", on),
    }
    for name, value in (("level_attempts", "attempts"), ("level_duration", "duration"), ("time_remaining", "time_remaining"),
                        ("rank_easing", "rank_easing"), ("effective_multiplier", "multiplier"), ("fps", "fps")):
        out |= {f"{name}_{m}": _measure(m, value, on) for m in ("std", "max", "min")}
    for kind in ("space", "time"):
        total = _sum0(f"resurrections_{kind}", on)
        out |= {f"resurrections_{kind}_sum": total, f"resurrections_{kind}": total}
        out |= {f"resurrections_{kind}_{m}": _measure(m, f"resurrections_{kind}", on) for m in ("mean", "std", "max")}
    for b in BOOSTERS:
        out |= {f"{b}_boosters_sum": _sum0(f"{b}_booster", on), f"{b}_boosters": _sum0(f"{b}_booster", on)}
        out |= {f"{b}_boosters_{m}": _measure(m, f"{b}_booster", on) for m in ("mean", "std", "max")}
    return out


def economy() -> dict[str, str]:
    out = {}
    for name in ("coin_balance", "life_balance", "crown_count", "undo_balance", "hammer_balance", "extrabox_balance"):
        out[f"{name}_start"] = f"min_by({name}, ts) FILTER (WHERE {name} IS NOT NULL)"
        out[f"{name}_end"] = f"max_by({name}, ts) FILTER (WHERE {name} IS NOT NULL)"
    return out | {"ad_events": _count("event_name LIKE '%ad%' OR event_name LIKE '%Ad%'"), "ad_revenue": _sum0("ad_revenue_usd")}


FILLED = ("levels_started", "levels_completed", "levels_failed")
BOOSTER_SUM = " + ".join(f"coalesce({b}_boosters, 0)" for b in BOOSTERS)
RATE = "CASE WHEN levels_started > 0 THEN CAST({0} AS DOUBLE) / levels_started ELSE 0 END"
CHANGES = ("coin_balance", "life_balance", "undo_balance", "hammer_balance", "extrabox_balance")

DERIVED = {
    "current_avg_attemptperuser": "CASE WHEN distinct_levels_played > 0 THEN total_level_attempts / distinct_levels_played ELSE 0 END",
    "day_of_month": "CAST(extract(DAY FROM session_date) AS INT)",
    "month": "CAST(extract(MONTH FROM session_date) AS INT)",
    "is_weekend": "CASE WHEN day_of_week IN (1, 7) THEN 1 ELSE 0 END",
    "completion_rate": RATE.format("levels_completed"),
    "total_boosters_used": BOOSTER_SUM,
    "booster_usage_rate": RATE.format(f"({BOOSTER_SUM})"),
    "total_resurrections": "coalesce(resurrections_space, 0) + coalesce(resurrections_time, 0)",
    "resurrection_rate": RATE.format("(coalesce(resurrections_space, 0) + coalesce(resurrections_time, 0))"),
    **{f"{c}_change": f"coalesce({c}_end, 0) - coalesce({c}_start, 0)" for c in CHANGES},
    "user_level_gain": "coalesce(user_level_end, 0) - coalesce(user_level_start, 0)",
    "daily_play_duration_seconds": "end_second - start_second",
    "avg_session_duration": "CASE WHEN daily_session_count > 0 THEN CAST(end_second - start_second AS DOUBLE) / daily_session_count ELSE 0 END",
}


def _nulled() -> dict[str, str]:
    """Level metrics are null on days without a level event; FILLED ones are 0 by their sums."""
    return {n: f"CASE WHEN level_event_count > 0 THEN {n} END" for n in level() if n not in (*FILLED, "level_event_count")}


def daily_features(events: DataFrame) -> DataFrame:
    """One row per user and day with all basic, level, economy and derived metrics."""
    metrics = {n: sql for n, sql in (basic() | level() | economy()).items() if sql != DISTINCT}
    key = F.struct("user_id", "session_date")  # structs with null fields are equal
    days = events.groupBy(key.alias("__day")).agg(*[F.expr(sql).alias(n) for n, sql in metrics.items()])
    for name, value in COUNTED.items():
        distinct = events.select(key.alias(f"__{name}"), F.expr(value).alias("__value")).where("__value IS NOT NULL").distinct()
        counts = distinct.groupBy(f"__{name}").agg(F.count(F.lit(1)).alias(f"__n_{name}"))
        days = days.join(counts, F.col("__day") == F.col(f"__{name}"), "left")
    days = days.select("__day.*", *[F.coalesce(f"__n_{n}", F.lit(0)).alias(n) if sql == DISTINCT else F.col(n) for n, sql in (basic() | level() | economy()).items()])
    nulled = _nulled()
    days = days.select(*[F.expr(nulled[c]).alias(c) if c in nulled else F.col(c) for c in days.columns])
    first = F.expr("min(session_date) OVER (PARTITION BY user_id)")
    days = days.withColumns(
        {
            "days_since_install": F.datediff("session_date", first),
            "day_of_week": F.dayofweek("session_date"),
            "day_no": F.unix_date("session_date"),
            "start_second": F.unix_timestamp(F.date_trunc("second", F.col("day_start_ts"))),
            "end_second": F.unix_timestamp(F.date_trunc("second", F.col("day_end_ts"))),
        }
    )
    return days.select("*", *[F.expr(sql).alias(n) for n, sql in DERIVED.items()]).drop("start_second", "end_second")

