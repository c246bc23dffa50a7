"""Constants of the decision domain, in one place."""

from __future__ import annotations

# Arms in order with their change of the multiplier, and its closed bounds.
ARMS = ("Easierer", "Easier", "Same", "Harder", "Harderer")
DELTAS = (-0.12, -0.06, 0.0, 0.06, 0.12)
LOW, HIGH = 0.5, 1.25

# Feature name parts and the namespace letter of the first that matches, in order.
NAMESPACES = (
    ("u", ("user_", "lifetime", "install", "cohort")),
    ("s", ("session", "play", "level", "attempt")),
    ("e", ("coin", "exchange", "spent", "balance")),
    ("t", ("day", "week", "weekend", "hour")),
    ("l", ("previous", "prev_")),
    ("e", ("ewma_",)),
)
OTHER_NAMESPACE = "f"

HIGH_ENGAGEMENT_SECONDS = 1800.0
WHALE_COINS = 10000.0
NEVER_SPENT_DAYS = 999
EWMA_ALPHAS = (0.1, 0.3, 0.5, 0.7)
TRAIN_PERCENT, VALID_PERCENT = 80, 90
WINSOR_QUANTILE = 0.999
QUANTILE_ACCURACY = 10_000  # rank error of at most 1 in so many; exact up to as many rows
WEIGHT_CLIP = 10.0
PROPENSITY_FLOOR = 1e-6
SRM_CRITICAL = 10.8276  # chi-square, one degree of freedom, p = 0.001
DEPLOY_LOSS_INCREASE = 0.05
EPS = 1e-9  # of sums of two-digit multipliers
