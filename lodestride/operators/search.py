"""Search for the settings of a learner: tree-structured Parzen proposals, median pruning, trials as parallel Spark jobs over stored folds.

After some random trials, finished ones are parted in the best few and the rest; for each setting two densities are made of them, and of some draws
from the density of the good ones that draw is proposed where good over rest is highest. A trial reports its loss fold by fold, and stops where its
mean so far is worse than the median of earlier trials at that fold. Trials run in rounds of ``parallel``; proposals and pruning look at
earlier rounds alone, so a seed gives the same table whatever the jobs' order.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame, SparkSession

# Proposals as the domain's search makes them.
STARTUP, CANDIDATES, GOOD_SHARE, MOST_GOOD = 10, 24, 0.1, 25
SEED = 42
OUT = "trial int, params map<string,string>, losses array<double>, loss double, state string"


@dataclass(frozen=True)
class Range:
    """A number from low to high; ``log``: evenly by its logarithm; ``whole``: an integer."""

    low: float
    high: float
    log: bool = False
    whole: bool = False

    def inner(self, x: float) -> float:
        return math.log(x) if self.log else float(x)

    def outer(self, x: float) -> float | int:
        x = min(max(math.exp(x) if self.log else x, self.low), self.high)
        return round(x) if self.whole else x


@dataclass(frozen=True)
class Choice:
    options: tuple


Space = dict[str, Range | Choice]


@dataclass
class Trial:
    number: int
    params: dict
    losses: list[float] = field(default_factory=list)
    state: str = "complete"

    @property
    def loss(self) -> float:
        return sum(self.losses) / len(self.losses) if self.losses else math.inf


def _random(space: Space, rng: np.random.Generator) -> dict:
    out = {}
    for name, kind in space.items():
        out[name] = kind.options[rng.integers(len(kind.options))] if isinstance(kind, Choice) else kind.outer(rng.uniform(kind.inner(kind.low), kind.inner(kind.high)))
    return out


class _Parzen:
    """A mixture of normal densities at ``points`` within a range, with a wide one over all of it."""

    def __init__(self, kind: Range, points: list[float]) -> None:
        self.low, self.high = kind.inner(kind.low), kind.inner(kind.high)
        width = self.high - self.low
        order = np.sort(np.array([*points, (self.low + self.high) / 2]))
        edges = np.concatenate([[self.low], order, [self.high]])
        spread = np.clip(np.maximum(edges[1:-1] - edges[:-2], edges[2:] - edges[1:-1]), width / min(100, 1 + len(order)), width)
        spread[np.searchsorted(order, (self.low + self.high) / 2)] = width
        self.centre, self.spread = order, spread

    def draw(self, rng: np.random.Generator, n: int) -> np.ndarray:
        at = rng.integers(len(self.centre), size=n)
        x = rng.normal(self.centre[at], self.spread[at])
        return np.where((x < self.low) | (x > self.high), rng.uniform(self.low, self.high, n), x)

    def log_density(self, x: np.ndarray) -> np.ndarray:
        z = (x[:, None] - self.centre) / self.spread
        return np.log((np.exp(-0.5 * z * z) / self.spread).mean(1) + 1e-300)


def propose(space: Space, done: list[Trial], rng: np.random.Generator, startup: int = STARTUP) -> dict:
    """Settings of the next trial."""
    if len(done) < startup:
        return _random(space, rng)
    # A trial that got further counts before one that was stopped, however low its loss was until then.
    ranked = sorted(done, key=lambda t: (-len(t.losses), t.loss, t.number))
    n = min(math.ceil(GOOD_SHARE * len(done)), MOST_GOOD)
    good, rest, out = ranked[:n], ranked[n:], {}
    for name, kind in space.items():
        if isinstance(kind, Choice):
            share = lambda trials: np.array([1 + sum(t.params[name] == o for t in trials) for o in kind.options]) / (len(kind.options) + len(trials))  # noqa: E731, B023
            a, b = share(good), share(rest)
            drawn = rng.choice(len(kind.options), size=CANDIDATES, p=a)
            out[name] = kind.options[int(drawn[np.argmax(np.log(a[drawn]) - np.log(b[drawn]))])]
        else:
            a, b = (_Parzen(kind, [kind.inner(t.params[name]) for t in trials]) for trials in (good, rest))
            drawn = a.draw(rng, CANDIDATES)
            out[name] = kind.outer(float(drawn[np.argmax(a.log_density(drawn) - b.log_density(drawn))]))
    return out


def run_trial(number: int, params: dict, objective: Callable[[dict, int], float], folds: int, earlier: list[Trial], least: int = 5) -> Trial:
    """One trial, fold by fold, until the end or its pruning; a loss that isn't a number counts as infinite."""
    trial = Trial(number, params)
    for fold in range(folds):
        loss = float(objective(params, fold))
        trial.losses.append(math.inf if math.isnan(loss) else loss)
        others = [sum(t.losses[: fold + 1]) / (fold + 1) for t in earlier if len(t.losses) > fold]
        if fold + 1 < folds and len(others) >= least and trial.loss > float(np.median(others)):
            trial.state = "pruned"
            break
    return trial


def search(space: Space, objective: Callable[[dict, int], float], folds: int, trials: int, seed: int = SEED, parallel: int = 4, startup: int = STARTUP) -> list[Trial]:
    """Trials in their order. ``objective`` gives the loss of settings on a fold, and may run Spark jobs: those of a round run side by side."""
    rng, done = np.random.default_rng(seed), []
    with ThreadPoolExecutor(parallel) as pool:
        while len(done) < trials:
            asked = [propose(space, done, rng, startup) for _ in range(min(parallel, trials - len(done)))]
            earlier, first = list(done), len(done)
            done += pool.map(lambda x: run_trial(first + x[0], x[1], objective, folds, earlier), enumerate(asked))  # noqa: B023
    return done


def best(done: list[Trial]) -> Trial:
    """The complete trial with the least loss, the first of equal ones."""
    return min((t for t in done if t.state == "complete"), key=lambda t: (t.loss, t.number))


def as_table(spark: SparkSession, done: list[Trial]) -> DataFrame:
    return spark.createDataFrame([(t.number, {k: str(v) for k, v in t.params.items()}, t.losses, t.loss, t.state) for t in done], OUT)
