"""An incremental learner of arm costs: hashed features, importance-weighted updates, one pass a day from yesterday's weights.

The cost of an arm is the negative reward; each arm has a linear model over the same hashed features (namespaces crossed with nothing, a constant
included). A row updates the model of the arm it was given, as if it had come 1 / propensity times at once (the update of that many
small steps, so a large weight never overshoots). A day's rows are learned where they are: every task takes yesterday's weights and
passes once over its rows, and the tasks' weights are averaged by the rows that taught each weight. Each row's cost is predicted before
the task learns from it, so the mean error of a day is a progressive validation loss and needs no held-out rows.

Models are arrays of arms x 2^bits weights, which is all that goes to tasks and comes back, however many rows or names there are. Rows without a reward or an
arm are left out; null features count as 0; an empty day leaves the model as it is. Order within a task is that of the rows, so a
result depends on how a day is partitioned, as it does for any learner of this kind.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestride.config import ARMS, PROPENSITY_FLOOR

BITS = 12
RATE = 0.05
CONSTANT = "constant"
OUT = "cell long, weight double, n double"


def slots(features: list[str], bits: int = BITS) -> np.ndarray:
    """Place of each feature, and last of the constant; names that collide share a weight."""
    return np.array([zlib.crc32(n.encode()) % (1 << bits) for n in [*features, CONSTANT]])


def empty_model(bits: int = BITS) -> np.ndarray:
    return np.zeros((len(ARMS), 1 << bits))


def learn(model: np.ndarray, at: np.ndarray, x: np.ndarray, arm: np.ndarray, cost: np.ndarray, importance: np.ndarray, rate: float, seen: np.ndarray) -> float:
    """One pass over rows in their order, in place; adds to ``seen`` the rows that taught each weight. Returns the summed squared error of the predictions before each update."""
    loss = 0.0
    for row, a, c, w in zip(x, arm, cost, importance):
        weights = model[a]
        error = c - float(np.dot(weights[at], row))
        loss += error * error
        square = float(np.dot(row, row))
        # Of w small steps towards c: the error that is left is error * exp(-w * rate * |x|^2).
        step = error * -math.expm1(-w * rate * square) / square if square else 0.0
        np.add.at(weights, at, step * row)
        np.add.at(seen[a], at, (row != 0).astype(float))
    return loss


def prepared(rows: DataFrame, features: list[str]) -> DataFrame:
    """arm, reward, pi_old and the features as one array of doubles."""
    x = F.array(*[F.coalesce(F.nanvl(F.col(f"`{c}`").cast("double"), F.lit(0.0)), F.lit(0.0)) for c in features])
    return rows.where("arm IS NOT NULL AND reward IS NOT NULL").select(F.col("arm").cast("int").alias("arm"), F.col("reward").cast("double").alias("reward"), F.col("pi_old").cast("double").alias("pi_old"), x.alias("x"))


def learn_day(rows: DataFrame, features: list[str], model: np.ndarray, rate: float = RATE) -> tuple[np.ndarray, int, float | None]:
    """The model after one pass over ``rows``, their number, and their progressive mean squared error (None without rows)."""
    shared = rows.sparkSession.sparkContext.broadcast((model, slots(features, int(math.log2(model.shape[1])))))

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before, at = shared.value
        own, seen, loss, n = before.copy(), np.zeros_like(before), 0.0, 0
        for b in batches:
            if not b.num_rows:
                continue
            x = b.column("x").flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, -1)
            x = np.hstack([x, np.ones((b.num_rows, 1))])
            pi = np.nan_to_num(b.column("pi_old").to_numpy(zero_copy_only=False), nan=1.0)
            loss += learn(own, at, x, b.column("arm").to_numpy(), -b.column("reward").to_numpy(), 1 / np.maximum(pi, PROPENSITY_FLOOR), rate, seen)
            n += b.num_rows
        cells = np.flatnonzero(seen)
        if n:  # the last cell holds the loss
            yield pa.RecordBatch.from_arrays([pa.array([*cells, -1]), pa.array([*(own.ravel()[cells] * seen.ravel()[cells]), loss]), pa.array([*seen.ravel()[cells], float(n)])], names=["cell", "weight", "n"])

    found = prepared(rows, features).mapInArrow(over, OUT).groupBy("cell").agg(F.sum("weight").alias("weight"), F.sum("n").alias("n")).collect()  # the size of the model
    after, n, loss = model.copy(), 0, None
    for cell, weight, k in found:
        if cell < 0:
            n, loss = int(k), weight / k
        else:
            after.flat[cell] = weight / k
    return after, n, loss


def learn_days(rows: DataFrame, features: list[str], by: str = "session_date", model: np.ndarray | None = None, rate: float = RATE) -> tuple[np.ndarray, DataFrame]:
    """Day after day in order, and a table of n and loss by day. ``rows`` are read once a day, so they should be stored by ``by``."""
    model, out = empty_model() if model is None else model, []
    for (day,) in rows.select(by).distinct().orderBy(by).collect():  # one row a day
        model, n, loss = learn_day(rows.where(F.col(by) == F.lit(day)), features, model, rate)
        out.append((day, n, loss))
    return model, rows.sparkSession.createDataFrame(out, f"{by} {rows.schema[by].dataType.simpleString()}, n long, loss double")


def with_costs(rows: DataFrame, features: list[str], model: np.ndarray) -> DataFrame:
    """``rows`` with an array ``costs`` of each arm's predicted cost: a sum of products, so in the JVM and without a copy of the model."""
    at = slots(features, int(math.log2(model.shape[1])))
    value = lambda c: F.coalesce(F.nanvl(F.col(f"`{c}`").cast("double"), F.lit(0.0)), F.lit(0.0))
    x = F.array(*map(value, features), F.lit(1.0))
    cost = lambda a: F.aggregate(F.zip_with(x, F.array(*[F.lit(float(model[a][i])) for i in at]), lambda v, w: v * w), F.lit(0.0), lambda s, v: s + v)
    return rows.withColumn("costs", F.array(*[cost(a) for a in range(len(ARMS))]))
