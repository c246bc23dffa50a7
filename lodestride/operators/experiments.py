"""Group-sequential looks at a running experiment: boundaries by alpha spending, and a verdict for each day.

Looking at a test every day and stopping at the first 1.96 finds an effect where none is in far more than 5 % of cases.
A spending function says how much of the error may be used up to each look; boundaries follow from it one after
another, by integrating over the paths that no earlier look has stopped.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from statistics import NormalDist

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lodestride.operators.ope import with_weights

NODES = 601  # of the integration; odd, for Simpson's rule
_PHI = np.vectorize(lambda x: 0.5 * math.erfc(-x / math.sqrt(2)), otypes=[float])


def obrien_fleming(t: float, alpha: float) -> float:
    """Error spent by the share ``t`` of the information, little of it early: half of it on either side."""
    return 2 * math.erfc(NormalDist().inv_cdf(1 - alpha / 4) / math.sqrt(2 * t))


def pocock(t: float, alpha: float) -> float:
    """Error spent evenly, nearly."""
    return alpha * math.log(1 + (math.e - 1) * t)


def boundaries(times: Sequence[float], alpha: float = 0.05, spending: Callable[[float, float], float] | Sequence[float] = obrien_fleming) -> list[float]:
    """Bounds of |z| at the shares ``times`` of the information (ascending, the last is 1 as a rule); inf where nothing may be spent.

    ``spending`` is a function of share and alpha, or the cumulative error at each look.
    """
    spent = [spending(t, alpha) for t in times] if callable(spending) else list(spending)
    if len(spent) != len(times) or any(b < a for a, b in zip(spent, spent[1:])) or any(b <= a for a, b in zip(times, times[1:])) or times[0] <= 0:
        raise ValueError("times must ascend and error can only grow")
    out: list[float] = []
    grid = density = None  # of the sum of all increments so far, on paths that haven't stopped
    for i, t in enumerate(times):
        step = math.sqrt(t - (times[i - 1] if i else 0.0))
        more = spent[i] - (spent[i - 1] if i else 0.0)

        def stops(u: float) -> float:
            if grid is None:
                return float(2 * _PHI(np.array(-u / step)))
            return float((density * (_PHI((-u - grid) / step) + _PHI((grid - u) / step))).sum())

        low, high = 0.0, 12 * math.sqrt(t)
        for _ in range(60):
            middle = (low + high) / 2
            low, high = (middle, high) if stops(middle) > more else (low, middle)
        out.append(high / math.sqrt(t) if more > 0 else math.inf)
        u = min(high, 9 * math.sqrt(t)) if more > 0 else 9 * math.sqrt(t)
        nodes = np.linspace(-u, u, NODES)
        simpson = np.where(np.arange(NODES) % 2, 4.0, 2.0)
        simpson[[0, -1]] = 1.0
        normal = lambda x: np.exp(-0.5 * x * x) / (math.sqrt(2 * math.pi) * step)  # noqa: E731, B023
        height = normal(nodes / step) if grid is None else (density[None, :] * normal((nodes[:, None] - grid[None, :]) / step)).sum(1)
        grid, density = nodes, height * simpson * (nodes[1] - nodes[0]) / 3
    return out


def daily_looks(rows: DataFrame, looks: int, bounds: Sequence[float], critical: float = 1.959963984540054) -> DataFrame:
    """One row a day of data: session_date, look (days since the first, from 1), theta_treatment, theta_control, lift, lift_pct, se, z, ci_low, ci_high, boundary, verdict, stopped.

    theta is SNIPS of all rows of a group up to the day; its variance is that of a ratio of sums over users, who may have rows on many
    days. Squares of users' running sums change only on days on which they have rows, so their changes add up by
    day, and no user is carried through days without rows. ``stopped``: an earlier look has decided. Looks after the planned ones have no boundary.

    Rows have grp, user_id, session_date, arm, reward, pi_old, multiplier; the table of days is the only one that isn't spread.
    """
    scored = with_weights(rows).select("grp", "user_id", "session_date", (F.col("w") * F.col("reward")).alias("d"), F.when(F.col("reward").isNotNull(), F.col("w")).alias("n"))
    days = scored.groupBy("grp", "user_id", "session_date").agg(F.coalesce(F.sum("d"), F.lit(0.0)).alias("d"), F.coalesce(F.sum("n"), F.lit(0.0)).alias("n"))
    upto = Window.partitionBy("grp", "user_id").orderBy("session_date")
    days = days.withColumns({"ud": F.sum("d").over(upto), "un": F.sum("n").over(upto)})
    d0, n0 = F.col("ud") - F.col("d"), F.col("un") - F.col("n")
    moved = {"d": F.col("d"), "n": F.col("n"), "dd": F.col("ud") * F.col("ud") - d0 * d0, "dn": F.col("ud") * F.col("un") - d0 * n0, "nn": F.col("un") * F.col("un") - n0 * n0}
    groups = ("treatment", "control")
    by_day = days.groupBy("session_date").agg(*[F.coalesce(F.sum(F.when(F.col("grp") == g, c)), F.lit(0.0)).alias(f"{k}_{g}") for g in groups for k, c in moved.items()])
    by_date = Window.orderBy("session_date")  # one row a day
    sums = by_day.select("session_date", *[F.sum(f"{k}_{g}").over(by_date).alias(f"{k}_{g}") for g in groups for k in moved], (F.datediff("session_date", F.min("session_date").over(by_date)) + 1).alias("look"))
    theta = {g: F.try_divide(f"d_{g}", f"n_{g}") for g in groups}
    variance = lambda g: F.try_divide(F.col(f"dd_{g}") - 2 * theta[g] * F.col(f"dn_{g}") + theta[g] * theta[g] * F.col(f"nn_{g}"), F.col(f"n_{g}") * F.col(f"n_{g}"))
    out = sums.select("session_date", "look", *[theta[g].alias(f"theta_{g}") for g in groups], (variance("treatment") + variance("control")).alias("v"))
    out = out.withColumn("se", F.when(F.col("v").isNotNull(), F.sqrt(F.greatest("v", F.lit(0.0)))))  # rounding may leave less than 0
    out = out.withColumn("lift", F.col("theta_treatment") - F.col("theta_control"))
    relative = lambda c: F.try_divide(c, F.abs("theta_control"))
    out = out.withColumns({"z": F.try_divide("lift", "se"), "lift_pct": relative(F.col("lift")), "ci_low": relative(F.col("lift") - critical * F.col("se")), "ci_high": relative(F.col("lift") + critical * F.col("se"))})
    bound = F.get(F.array(*[F.lit(float(b)) for b in bounds[:looks]]), F.col("look") - 1)
    out = out.withColumn("boundary", bound)
    crossed = F.coalesce(F.abs("z") >= F.col("boundary"), F.lit(False))
    verdict = F.when(crossed & (F.col("z") > 0), "better").when(crossed, "worse").when(F.col("look") >= looks, "no difference").otherwise("continue")
    before = Window.orderBy("session_date").rowsBetween(Window.unboundedPreceding, -1)
    return out.withColumn("verdict", verdict).withColumn("stopped", F.coalesce(F.max(crossed.cast("int")).over(before), F.lit(0)) > 0)
