"""DuckDB twins of the daily metrics, actions, labels and the window features, written from their definitions and not from the plan's expressions.

Daily metrics are three grouped queries that are joined (basic, level and economy), as the domain describes them. Window features
look up earlier rows by row number, where the plan has window frames.
"""

from __future__ import annotations

LEVEL = ("levelStarted", "levelEnded", "levelOutOfSpace", "levelOutOfTime")
ENDED = LEVEL[1:]


def _names(values: tuple[str, ...]) -> str:
    return ", ".join(f"'{v}'" for v in values)


def _basic() -> str:
    out = []
    for kind, names in (("RealCurrency", ("current_spend", "daily_spend_real_sum", "daily_spend_real")), ("VirtualCurrency", ("current_exchangespentamountcoins", "daily_spend_coins_sum", "daily_spend_coins"))):
        only = f"FILTER (WHERE spend_type = '{kind}')"
        out += [f"coalesce(sum(spend_amount) {only}, 0)::DOUBLE AS {n}" for n in names]
        out += [f"({f}(spend_amount) {only})::DOUBLE AS {names[2]}_{m}" for m, f in (("mean", "avg"), ("std", "stddev"), ("max", "max"), ("min", "min"))]
    out += ["min(ts) AS day_start_ts", "max(ts) AS day_end_ts"]
    out += [f"arg_min({c}, ts) FILTER (WHERE {c} IS NOT NULL) AS {n}" for c, n in (("user_segment", "user_segment"), ("platform", "platform"), ("user_level", "user_level_start"))]
    out += ["arg_max(user_level, ts) FILTER (WHERE user_level IS NOT NULL) AS user_level_end", "count(*) AS daily_event_count", "count(DISTINCT session_id) AS daily_session_count"]
    return f"SELECT user_id, session_date, {', '.join(out)} FROM game GROUP BY ALL"


def _level() -> str:
    out = [
        "count(*) AS level_event_count",
        "count(*) FILTER (WHERE event_name = 'levelStarted') AS levels_started",
        f"count(*) FILTER (WHERE event_name IN ({_names(ENDED)}) AND level_result = 'Victory') AS levels_completed",
        f"count(*) FILTER (WHERE event_name IN ({_names(ENDED)}) AND level_result IN ('Defeat', 'Abort')) AS levels_failed",
        "coalesce(sum(attempts), 0)::DOUBLE AS total_level_attempts",
        "count(DISTINCT level_index) AS distinct_levels_played",
        "coalesce(sum(duration), 0)::DOUBLE AS total_level_duration",
    ]
    for column, mean, name in (("attempts", "avg_level_attempts", "level_attempts"), ("duration", "avg_level_duration", "level_duration"), ("time_remaining", "avg_time_remaining", "time_remaining"),
                               ("rank_easing", "avg_rank_easing", "rank_easing"), ("multiplier", "avg_effective_multiplier", "effective_multiplier"), ("fps", "avg_fps", "fps")):
        out += [f"avg({column})::DOUBLE AS {mean}", f"stddev({column})::DOUBLE AS {name}_std", f"max({column})::DOUBLE AS {name}_max", f"min({column})::DOUBLE AS {name}_min"]
    summed = [(f"resurrections_{k}", f"resurrections_{k}") for k in ("space", "time")] + [(f"{b}_booster", f"{b}_boosters") for b in ("undo", "extrabox", "hammer", "joker", "prejoker", "supersuit")]
    for column, name in summed:
        out += [f"coalesce(sum({column}), 0)::DOUBLE AS {name}", f"coalesce(sum({column}), 0)::DOUBLE AS {name}_sum"]
        out += [f"avg({column})::DOUBLE AS {name}_mean", f"stddev({column})::DOUBLE AS {name}_std", f"max({column})::DOUBLE AS {name}_max"]
    return f"SELECT user_id, session_date, {', '.join(out)} FROM game WHERE event_name IN ({_names(LEVEL)}) GROUP BY ALL"


def _economy() -> str:
    out = []
    for c in ("coin_balance", "life_balance", "crown_count", "undo_balance", "hammer_balance", "extrabox_balance"):
        out += [f"{f}({c}, ts) FILTER (WHERE {c} IS NOT NULL) AS {c}_{n}" for f, n in (("arg_min", "start"), ("arg_max", "end"))]
    out += ["count(*) FILTER (WHERE event_name LIKE '%ad%' OR event_name LIKE '%Ad%') AS ad_events", "coalesce(sum(ad_revenue_usd), 0)::DOUBLE AS ad_revenue"]
    return f"SELECT user_id, session_date, {', '.join(out)} FROM game GROUP BY ALL"


def daily() -> str:
    """Common table expressions up to ``daily``, after ``game``."""
    per_start = "CASE WHEN levels_started > 0 THEN ({0})::DOUBLE / levels_started ELSE 0 END"
    boosters = " + ".join(f"coalesce({b}_boosters, 0)" for b in ("undo", "extrabox", "hammer", "joker", "prejoker", "supersuit"))
    rescued = "coalesce(resurrections_space, 0) + coalesce(resurrections_time, 0)"
    played = "(date_diff('second', date_trunc('second', day_start_ts), date_trunc('second', day_end_ts)))"
    derived = {
        "days_since_install": "(session_date - first_day)::INT",
        "day_of_week": "(isodow(session_date) % 7 + 1)::INT",
        "day_no": "(session_date - DATE '1970-01-01')::INT",
        "day_of_month": "day(session_date)::INT",
        "month": "month(session_date)::INT",
        "is_weekend": "CASE WHEN isodow(session_date) >= 6 THEN 1 ELSE 0 END",
        "current_avg_attemptperuser": "CASE WHEN distinct_levels_played > 0 THEN total_level_attempts / distinct_levels_played ELSE 0 END",
        "completion_rate": per_start.format("levels_completed"),
        "total_boosters_used": boosters,
        "booster_usage_rate": per_start.format(boosters),
        "total_resurrections": rescued,
        "resurrection_rate": per_start.format(rescued),
        **{f"{c}_change": f"coalesce({c}_end, 0) - coalesce({c}_start, 0)" for c in ("coin_balance", "life_balance", "undo_balance", "hammer_balance", "extrabox_balance")},
        "user_level_gain": "coalesce(user_level_end, 0) - coalesce(user_level_start, 0)",
        "daily_play_duration_seconds": played,
        "avg_session_duration": f"CASE WHEN daily_session_count > 0 THEN {played}::DOUBLE / daily_session_count ELSE 0 END",
    }
    return f"""basic AS ({_basic()}), level AS ({_level()}), economy AS ({_economy()}),
  first_days AS (SELECT user_id, min(session_date) AS first_day FROM game GROUP BY ALL),
  days AS (SELECT * REPLACE (coalesce(level_event_count, 0) AS level_event_count, coalesce(levels_started, 0) AS levels_started, coalesce(levels_completed, 0) AS levels_completed, coalesce(levels_failed, 0) AS levels_failed)
    FROM basic LEFT JOIN level USING (user_id, session_date) LEFT JOIN economy USING (user_id, session_date) LEFT JOIN first_days USING (user_id)),
  daily AS (SELECT * EXCLUDE (first_day), {", ".join(f"{sql} AS {n}" for n, sql in derived.items())} FROM days)"""


# Window features: c is the row, p runs over earlier rows of the user; n numbers a user's rows.


def _earlier(agg: str, k: int | None = None, least: int = 1) -> str:
    low = f" AND p.n >= c.n - {k}" if k else ""
    return f"(SELECT {agg} FROM t p WHERE p.user_id = c.user_id AND p.n <= c.n - {least}{low})"


def _since(stop: str) -> str:
    """Rows up to the one before c since the last on which ``stop`` holds, without it."""
    return f"(c.n - 1 - coalesce({_earlier(f'max(CASE WHEN {stop} THEN p.n END)')}, 0))"


MOVED, GAP = "p.before_m IS NULL OR abs(p.m - p.before_m) >= 0.01", "p.before_day IS NULL OR p.day_no - p.before_day > 1"
RATIO = "CASE WHEN sum(p.levels_started) > 0 THEN sum(p.levels_completed)::DOUBLE / sum(p.levels_started) ELSE 0 END"

FEATURES: dict[str, str] = {
    **{f"rolling_win_rate_{k}d": _earlier("avg(p.completion_rate)", k) for k in (3, 5, 7)},
    **{f"difficulty_variance_{k}d": _earlier("stddev(p.m)", k) for k in (3, 5, 7)},
    **{f"preferred_difficulty_{k}d": _earlier("avg(p.m)", k) for k in (3, 5, 7)},
    "consecutive_days_streak": f"CASE WHEN c.n > 1 THEN {_since(GAP)} + 1 ELSE 0 END",
    "performance_momentum": f"{_earlier('avg(p.completion_rate)', 3)} - {_earlier('avg(p.completion_rate)', 10, 4)}",
    **{f"rolling_completions_{k}d": f"{_earlier('sum(p.levels_completed)', k)}::BIGINT" for k in (3, 5)},
    **{f"rolling_completion_rate_{k}d": _earlier(RATIO, k) for k in (3, 5)},
    **{f"skill_variance_{k}d": _earlier("stddev(p.current_avg_attemptperuser)", k) for k in (3, 5)},
    **{f"high_engagement_days_{k}d": _earlier("count(*) FILTER (WHERE p.daily_play_duration_seconds >= 1800)", k) for k in (3, 5)},
    "is_spender_7d": f"({_earlier('count(*) FILTER (WHERE p.daily_spend_coins > 0)', 7)} > 0)::INT",
    "days_since_last_spend": f"coalesce(c.day_no - {_earlier('max(CASE WHEN p.daily_spend_coins > 0 THEN p.day_no END)')}, 999)",
    "spending_frequency_7d": f"{_earlier('count(*) FILTER (WHERE p.daily_spend_coins > 0)', 7)} / 7.0::DOUBLE",
    "avg_spend_per_active_day_7d": _earlier("avg(p.daily_spend_coins) FILTER (WHERE p.daily_spend_coins > 0)", 7),
    "spending_volatility_7d": _earlier("stddev(p.daily_spend_coins)", 7),
    "consecutive_wins_streak": _since("NOT p.completion_rate > 0.5"),
    "consecutive_losses_streak": _since("p.completion_rate > 0.5"),
    "win_loss_ratio_3d": _earlier(RATIO, 3),
    "recent_struggle_indicator": f"coalesce({_earlier('max(p.completion_rate)', 1)} < 0.3, FALSE)::INT",
    "lifecycle_new_user": "(c.days_since_install <= 7)::INT",
    "lifecycle_early": "(c.days_since_install BETWEEN 8 AND 30)::INT",
    "lifecycle_established": "(c.days_since_install BETWEEN 31 AND 90)::INT",
    "lifecycle_veteran": "(c.days_since_install > 90)::INT",
    "install_month": "(SELECT month(min(p.session_date)) FROM t p WHERE p.user_id = c.user_id)::INT",
    "total_lifetime_coins_spent": _earlier("sum(p.daily_spend_coins)"),
    "is_whale": f"(coalesce({_earlier('sum(p.daily_spend_coins)')}, 0) >= 10000)::INT",
    "difficulty_trend_3d": _earlier("CASE WHEN count(*) > 1 THEN regr_slope(p.m, p.n) ELSE 0 END", 3),
    "difficulty_change_magnitude_3d": _earlier("sum(abs(p.m - p.before_m))", 3),
    "time_at_current_difficulty": f"CASE WHEN c.n > 1 THEN {_since(MOVED)} + 1 ELSE 0 END",
    "distance_from_comfort_zone": f"abs(c.m - {_earlier('avg(p.m)', 7)})",
    "session_intensity_3d": _earlier("avg(p.daily_event_count)", 3),
    "playtime_trend_3d": _earlier("CASE WHEN count(*) > 1 THEN regr_slope(p.daily_play_duration_seconds, p.n) ELSE 0 END", 3),
    "days_since_last_play": _earlier("max(p.day_no - p.before_day - 1)", 1),
    "weekend_warrior": f"(coalesce({_earlier('avg(p.is_weekend)', 7)}, 0) > 0.5)::INT",
    "skill_x_difficulty": "c.current_avg_attemptperuser * c.m",
    "spend_x_completion": "c.daily_spend_coins * c.completion_rate",
    "playtime_x_skill": "c.daily_play_duration_seconds * c.current_avg_attemptperuser",
}


def features(names: list[str]) -> str:
    """Tables and SELECT of user_id, session_date and the features, after ``bandit``."""
    picked = ", ".join(f"round(coalesce({FEATURES[n]}, 0), 6) AS {n}" for n in names)
    return f""", numbered AS (SELECT *, current_effectivelevelmultiplier AS m, row_number() OVER (PARTITION BY user_id ORDER BY session_date) AS n FROM bandit),
  t AS (SELECT a.*, b.m AS before_m, b.day_no AS before_day FROM numbered a LEFT JOIN numbered b ON b.user_id = a.user_id AND b.n = a.n - 1)
  SELECT c.user_id, c.session_date, {picked} FROM t c"""


# Labels in hundredths of the multiplier's change, from the definition of the arms (a step of 0.06 or 0.12, give or take 0.01).
STEPS = "(VALUES ('Same', 0, 0), ('Harder', 5, 7), ('Easier', -7, -5), ('Harderer', 11, 13), ('Easierer', -13, -11)) steps(arm, low, high)"


def actions() -> str:
    """logged, moved and arms: the first start of a day by number, the next row by number, changes in whole hundredths."""
    return f"""starts AS (SELECT user_id, session_date, multiplier, row_number() OVER (PARTITION BY user_id, session_date ORDER BY ts, event_id) AS place FROM game
      WHERE event_name = 'levelStarted' AND multiplier IS NOT NULL AND assist = 0),
    logged AS (SELECT user_id, session_date, multiplier FROM starts WHERE place = 1),
    counted AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY session_date) AS i FROM logged),
    changes AS (SELECT a.user_id, a.session_date, a.multiplier, b.multiplier AS next_multiplier, CAST(round(b.multiplier * 100) - round(a.multiplier * 100) AS INT) AS hundredths,
      round(a.multiplier * 100) AS now FROM counted a LEFT JOIN counted b ON b.user_id = a.user_id AND b.i = a.i + 1),
    held AS (SELECT *, CASE WHEN (now >= 125 AND hundredths > 0) OR (now <= 50 AND hundredths < 0) THEN 0 ELSE hundredths END AS step FROM changes),
    moved AS (SELECT user_id, session_date, multiplier, next_multiplier, step, CAST(step AS DOUBLE) / 100 AS action FROM held),
    arms AS (SELECT user_id, session_date, multiplier, next_multiplier, action, arm AS difficulty_arm FROM moved JOIN {STEPS} ON step BETWEEN low AND high)"""


def bandit() -> str:
    """The decision dataset after daily and arms: earlier and later rows by number."""
    return """decided_rows AS (SELECT d.*, a.multiplier AS current_effectivelevelmultiplier, a.action, a.next_multiplier AS next_effectivelevelmultiplier, a.difficulty_arm,
      row_number() OVER (PARTITION BY d.user_id ORDER BY d.session_date) AS place FROM daily d JOIN arms a ON a.user_id = d.user_id AND a.session_date = d.session_date),
    bandit AS (SELECT c.* EXCLUDE (place), n.current_exchangespentamountcoins AS next_day_reward, coalesce(p.action, 0) AS previous_day_action,
      coalesce(p.current_effectivelevelmultiplier, c.current_effectivelevelmultiplier) AS previous_day_multiplier
      FROM decided_rows c JOIN decided_rows n ON n.user_id = c.user_id AND n.place = c.place + 1 LEFT JOIN decided_rows p ON p.user_id = c.user_id AND p.place = c.place - 1
      WHERE n.current_exchangespentamountcoins IS NOT NULL)"""
