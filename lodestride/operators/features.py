"""Window features over each user's labelled rows, as a registry of SQL expressions.

Frames are rows before the current one, not calendar days. A feature's layers are computed one
after another, each in one select; only the layers and columns that the asked features need are
computed, and Catalyst prunes what feeds them.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestride.config import HIGH_ENGAGEMENT_SECONDS, NEVER_SPENT_DAYS, WHALE_COINS

BY = "PARTITION BY user_id ORDER BY session_date"
MULT, RATE, COINS, PLAY = "current_effectivelevelmultiplier", "completion_rate", "daily_spend_coins", "daily_play_duration_seconds"


def over(agg: str, start: int | str, end: int = 1) -> str:
    return f"{agg} OVER ({BY} ROWS BETWEEN {start} PRECEDING AND {end} PRECEDING)"


def running(agg: str) -> str:
    return f"{agg} OVER ({BY} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"


def lagged(x: str) -> str:
    return f"lag({x}) OVER ({BY})"


def slope(y: str, k: int = 3) -> str:
    """Least-squares slope on the row number over the k rows before; 0 if degenerate."""
    n, sx = over("count(*)", k), over("sum(h_t)", k)
    sy, sxy, sxx = over(f"sum({y})", k), over(f"sum(h_t * {y})", k), over("sum(h_t * h_t)", k)
    down = f"({n} * {sxx} - {sx} * {sx})"
    return f"coalesce(CASE WHEN {down} > 0 THEN CAST({n} * {sxy} - {sx} * {sy} AS DOUBLE) / {down} ELSE 0 END, 0)"


# Helper columns (h_), by layer; each may use those of earlier layers.
HELPERS: tuple[dict[str, str], ...] = (
    {
        "h_t": f"row_number() OVER ({BY})",
        "h_new_days": f"CASE WHEN day_no - {lagged('day_no')} <= 1 THEN 0 ELSE 1 END",
        "h_gap": f"coalesce(day_no - {lagged('day_no')} - 1, 0)",
        "h_engaged": f"CASE WHEN {PLAY} >= {HIGH_ENGAGEMENT_SECONDS} THEN 1 ELSE 0 END",
        "h_spent": f"CASE WHEN {COINS} > 0 THEN 1 ELSE 0 END",
        "h_win": f"CASE WHEN {RATE} > 0.5 THEN 1 ELSE 0 END",
        "h_loss": f"CASE WHEN {RATE} <= 0.5 THEN 1 ELSE 0 END",
        "h_move": f"abs({MULT} - {lagged(MULT)})",
        "h_comfort": over(f"avg({MULT})", 7),
    },
    {
        "h_seg_days": running("sum(h_new_days)"),
        "h_seg_win": running(f"sum(CASE WHEN h_win = 1 AND coalesce({{lag_win}}, 1) <> 1 THEN 1 ELSE 0 END)"),
        "h_seg_loss": running(f"sum(CASE WHEN h_loss = 1 AND coalesce({{lag_loss}}, 1) <> 1 THEN 1 ELSE 0 END)"),
        "h_seg_move": running("sum(CASE WHEN h_move < 0.01 THEN 0 ELSE 1 END)"),
    },
    {
        "h_pos_days": "row_number() OVER (PARTITION BY user_id, h_seg_days ORDER BY session_date)",
        "h_pos_win": "CASE WHEN h_win = 1 THEN row_number() OVER (PARTITION BY user_id, h_seg_win ORDER BY session_date) ELSE 0 END",
        "h_pos_loss": "CASE WHEN h_loss = 1 THEN row_number() OVER (PARTITION BY user_id, h_seg_loss ORDER BY session_date) ELSE 0 END",
        "h_pos_move": "row_number() OVER (PARTITION BY user_id, h_seg_move ORDER BY session_date)",
    },
)
# A window can't stand inside another window's aggregate, so lags of flags are columns of the first layer.
HELPERS[0]["h_was_win"] = lagged(f"CASE WHEN {RATE} > 0.5 THEN 1 ELSE 0 END")
HELPERS[0]["h_was_loss"] = lagged(f"CASE WHEN {RATE} <= 0.5 THEN 1 ELSE 0 END")
for _flag in ("win", "loss"):
    HELPERS[1][f"h_seg_{_flag}"] = HELPERS[1][f"h_seg_{_flag}"].replace(f"{{lag_{_flag}}}", f"h_was_{_flag}")

GROUPS: dict[str, dict[str, str]] = {
    "rolling_win_rate": {f"rolling_win_rate_{k}d": over(f"avg({RATE})", k) for k in (3, 5, 7)},
    "difficulty_comfort": {
        **{f"difficulty_variance_{k}d": over(f"stddev_samp({MULT})", k) for k in (3, 5, 7)},
        **{f"preferred_difficulty_{k}d": over(f"avg({MULT})", k) for k in (3, 5, 7)},
    },
    "days_streak": {"consecutive_days_streak": f"coalesce({lagged('h_pos_days')}, 0)"},
    "momentum": {"performance_momentum": f"{over(f'avg({RATE})', 3)} - {over(f'avg({RATE})', 10, 4)}"},
    "rolling_completion": {
        **{f"rolling_completions_{k}d": f"CAST({over('sum(levels_completed)', k)} AS BIGINT)" for k in (3, 5)},
        **{f"rolling_completion_rate_{k}d": f"CASE WHEN {over('sum(levels_started)', k)} > 0 THEN CAST({over('sum(levels_completed)', k)} AS DOUBLE) / {over('sum(levels_started)', k)} ELSE 0 END" for k in (3, 5)},
    },
    "skill_variance": {f"skill_variance_{k}d": over("stddev_samp(current_avg_attemptperuser)", k) for k in (3, 5)},
    "high_engagement": {f"high_engagement_days_{k}d": f"CAST({over('sum(h_engaged)', k)} AS BIGINT)" for k in (3, 5)},
    "spending_propensity": {
        "is_spender_7d": over("max(h_spent)", 7),
        "days_since_last_spend": f"coalesce(day_no - {over(f'max(CASE WHEN {COINS} > 0 THEN day_no END)', 'UNBOUNDED')}, {NEVER_SPENT_DAYS})",
        "spending_frequency_7d": f"CAST({over('sum(h_spent)', 7)} AS DOUBLE) / 7",
        "avg_spend_per_active_day_7d": f"coalesce({over(f'avg(CASE WHEN {COINS} > 0 THEN {COINS} END)', 7)}, 0)",
        "spending_volatility_7d": f"coalesce({over(f'stddev_samp({COINS})', 7)}, 0)",
    },
    "win_loss_streaks": {"consecutive_wins_streak": f"coalesce({lagged('h_pos_win')}, 0)", "consecutive_losses_streak": f"coalesce({lagged('h_pos_loss')}, 0)"},
    "win_loss_ratio": {
        "win_loss_ratio_3d": f"CASE WHEN {over('sum(levels_started)', 3)} > 0 THEN CAST({over('sum(levels_completed)', 3)} AS DOUBLE) / {over('sum(levels_started)', 3)} ELSE 0 END",
        "recent_struggle_indicator": f"CASE WHEN {lagged(RATE)} < 0.3 THEN 1 ELSE 0 END",
    },
    "lifecycle": {
        "lifecycle_new_user": "CASE WHEN days_since_install <= 7 THEN 1 ELSE 0 END",
        "lifecycle_early": "CASE WHEN days_since_install > 7 AND days_since_install <= 30 THEN 1 ELSE 0 END",
        "lifecycle_established": "CASE WHEN days_since_install > 30 AND days_since_install <= 90 THEN 1 ELSE 0 END",
        "lifecycle_veteran": "CASE WHEN days_since_install > 90 THEN 1 ELSE 0 END",
        "install_month": "CAST(extract(MONTH FROM min(session_date) OVER (PARTITION BY user_id)) AS INT)",
    },
    "whale": {
        "total_lifetime_coins_spent": f"coalesce({over(f'sum({COINS})', 'UNBOUNDED')}, 0)",
        "is_whale": f"CASE WHEN coalesce({over(f'sum({COINS})', 'UNBOUNDED')}, 0) >= {WHALE_COINS} THEN 1 ELSE 0 END",
    },
    "difficulty_trend": {"difficulty_trend_3d": slope(MULT)},
    "difficulty_trajectory": {
        "difficulty_change_magnitude_3d": f"coalesce({over('sum(h_move)', 3)}, 0)",
        "time_at_current_difficulty": f"coalesce({lagged('h_pos_move')}, 0)",
        "distance_from_comfort_zone": f"abs({MULT} - h_comfort)",
    },
    "engagement_patterns": {
        "session_intensity_3d": f"coalesce({over('avg(daily_event_count)', 3)}, 0)",
        "playtime_trend_3d": slope(PLAY),
        "days_since_last_play": f"coalesce({lagged('h_gap')}, 0)",
        "weekend_warrior": f"CASE WHEN {over('avg(is_weekend)', 7)} > 0.5 THEN 1 ELSE 0 END",
    },
    "interactions": {
        "skill_x_difficulty": f"current_avg_attemptperuser * {MULT}",
        "spend_x_completion": f"{COINS} * {RATE}",
        "playtime_x_skill": f"{PLAY} * current_avg_attemptperuser",
    },
}
FEATURES = {name: sql for group in GROUPS.values() for name, sql in group.items()}


def layers(features: dict[str, str]) -> list[dict[str, str]]:
    """The helper layers that ``features`` need, then the features with null as 0."""
    needed, out = set(re.findall(r"\bh_\w+", " ".join(features.values()))), []
    for helpers in reversed(HELPERS):
        used = {n: helpers[n] for n in helpers if n in needed}
        needed |= set(re.findall(r"\bh_\w+", " ".join(used.values())))
        out.insert(0, used)
    return [x for x in out if x] + [{n: f"coalesce({sql}, 0)" for n, sql in features.items()}]


def add_features(rows: DataFrame, names: list[str] | None = None) -> DataFrame:
    """``rows`` with the named features (all by default)."""
    features = FEATURES if names is None else {n: FEATURES[n] for n in names}
    base = rows.columns
    for layer in layers(features):
        rows = rows.select("*", *[F.expr(sql).alias(n) for n, sql in layer.items()])
    return rows.select(*base, *features)

