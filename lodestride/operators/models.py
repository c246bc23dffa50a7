"""Models on decision rows: importances, propensities, reward models."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from multiprocessing.pool import ThreadPool

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml import Estimator, Model, Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestride.config import ARMS, PROPENSITY_FLOOR
from lodestride.operators.ope import LEVELS, poisson_steps
from lodestride.sources.scratch import scratch_path

SEED = 42
HELD = 100_000_000  # rows times trees that a forest may hold: about 20 bytes each, with counts and node ids
BLOCK = 16  # trees whose draws are found together: four to a hash
CELLS = 20_000  # of a task


def _assembled(rows: DataFrame, features: list[str]) -> DataFrame:
    return VectorAssembler(inputCols=features, outputCol="__x").transform(rows.fillna(0.0, subset=features))


@contextmanager
def _held(rows: DataFrame, columns: list[str], features: list[str]) -> Iterator[DataFrame]:
    """Assembled rows, found once, spread evenly over all cores and held while models are fitted.

    A fit reads its input several times, and works with as many cores as that has partitions: one, for a table in one small file.
    """
    cores = rows.sparkSession.sparkContext.defaultParallelism
    held = _assembled(rows.select(*columns, *features), features).select(*columns, "__x").repartition(cores).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield held
    finally:
        held.unpersist()


def _fitted(learners: dict[int, Estimator], rows: DataFrame) -> dict[int, Model]:
    """A model for each arm, fitted at the same time: a level of a tree is a short job, which alone leaves cores idle."""
    fit = inheritable_thread_target(rows.sparkSession)(lambda i: learners[i].fit(rows.where(F.col("arm") == i)))
    with ThreadPool(max(1, len(learners))) as pool:
        return dict(zip(learners, pool.map(fit, learners)))


def _ranking(rows: DataFrame, features: list[str], values: list[float]) -> DataFrame:
    pairs = F.array(*[F.struct(F.lit(f).alias("feature"), F.lit(float(v)).alias("importance")) for f, v in zip(features, values)])
    return rows.sparkSession.range(1).select(F.explode(pairs).alias("r")).select("r.*")


def forest_importances(rows: DataFrame, features: list[str], arm: str = "arm", trees: int = 100, depth: int = 10) -> DataFrame:
    """Importance of each feature in a forest that predicts the arm."""
    with _held(rows, [arm], features) as held:
        model = RandomForestClassifier(featuresCol="__x", labelCol=arm, numTrees=trees, maxDepth=depth, seed=SEED, cacheNodeIds=True).fit(held)
    return _ranking(rows, features, model.featureImportances.toArray())


def logistic_ranking(rows: DataFrame, features: list[str], arm: str = "arm") -> DataFrame:
    """Sum of absolute coefficients of each feature in a multinomial regression."""
    model = LogisticRegression(featuresCol="__x", labelCol=arm, maxIter=50, regParam=1e-4, family="multinomial").fit(_assembled(rows, features))
    return _ranking(rows, features, abs(model.coefficientMatrix.toArray()).sum(axis=0))


def arm_importances(rows: DataFrame, features: list[str], boosted: bool = False, least_rows: int = 500, trees: int = 150, depth: int = 12, key: list[str] | None = None) -> DataFrame:
    """Per arm with enough rows: feature importances of a reward model, normalized.

    A forest over rows holds a count and some node ids for each row and tree. Where features have few values, name the ``key`` that tells rows apart: forests
    of many rows are then grown by ``cell_importances``.

    Forests keep the node of each row in each tree. Boosting grows its trees one by one: to hold a column of nodes for each of 600 levels takes longer
    than to walk the six levels again, and the trees are the same.
    """
    if key and not boosted and rows.count() * trees > HELD:
        return cell_importances(rows, features, key, least_rows, trees, depth)
    out = None
    with _held(rows, ["arm", "reward"], features) as held:
        counts = {r.arm: r["count"] for r in held.groupBy("arm").count().collect()}  # five arms
        learner = lambda: (
            GBTRegressor(featuresCol="__x", labelCol="reward", maxIter=100, maxDepth=6, stepSize=0.1, seed=SEED)
            if boosted
            else RandomForestRegressor(featuresCol="__x", labelCol="reward", numTrees=trees, maxDepth=depth, seed=SEED, cacheNodeIds=True)
        )
        found = _fitted({i: learner() for i in range(len(ARMS)) if counts.get(i, 0) >= least_rows}, held)
    for i, model in found.items():
        ranked = _ranking(rows, features, model.featureImportances.toArray()).withColumn("arm", F.lit(i))
        out = ranked if out is None else out.unionByName(ranked)
    empty = _ranking(rows, features, [0.0] * len(features)).withColumn("arm", F.lit(-1)).where("false")
    return empty if out is None else out


def drawn_cells(rows: DataFrame, features: list[str], key: list[str], trees: int) -> DataFrame:
    """(arm, features, block, n, w0.., s0..): the rows of a cell (an arm and equal features), and how often trees draw them (w) with what rewards (s).

    Column j of block b is of tree BLOCK * b + j. Each tree draws each row a Poisson(1) number of times, by 16 bits of a hash of its key, so neither the
    order nor the place of rows matters. A reward that is missing is an error.
    """
    blocks, least = -(-trees // BLOCK), [t for x in poisson_steps() if (t := math.ceil(x * LEVELS - 0.5)) < LEVELS]
    reward = F.coalesce("reward", F.raise_error(F.lit("a reward is missing"))).alias("reward")
    kept = rows.where("arm IS NOT NULL").fillna(0.0, subset=features).select(*key, "arm", reward, *features, F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"))
    same = ["arm", *features, "block"]
    hashed = kept.select(*same, "reward", *[F.xxhash64(*key, "block", F.lit(i)).alias(f"h{i}") for i in range(BLOCK // 4)])
    cut = hashed.select(*same, "reward", *[F.shiftrightunsigned(F.col(f"h{j // 4}"), 16 * (j % 4)).bitwiseAND(F.lit(LEVELS - 1)).alias(f"u{j}") for j in range(BLOCK)])

    def times(u: Column) -> Column:
        k = F.when(u < least[0], 0)
        for i, t in enumerate(least[1:], 1):
            k = k.when(u < t, i)
        return k.otherwise(len(least))

    drawn = cut.select(*same, "reward", *[times(F.col(f"u{j}")).alias(f"k{j}") for j in range(BLOCK)])
    w, s = [F.sum(f"k{j}").alias(f"w{j}") for j in range(BLOCK)], [F.sum(F.col(f"k{j}") * F.col("reward")).alias(f"s{j}") for j in range(BLOCK)]
    return drawn.groupBy(*same).agg(F.count(F.lit(1)).alias("n"), *w, *s)


def cell_importances(rows: DataFrame, features: list[str], key: list[str], least_rows: int = 500, trees: int = 150, depth: int = 12) -> DataFrame:
    """As ``arm_importances`` by forests, for features of few values, so that many rows are alike; ``key`` tells rows apart.

    A split's gain depends on the weights and mean rewards of cells alone: how rewards differ within a cell is on both sides of it, and goes. So rows are
    read once and drawn for all trees, and each tree grows on the cells that it has drawn, with the splits that it would find over rows. What is stored is
    cells x trees, however many rows there are; to grow trees one by one takes about 15 small jobs a tree, however few.
    """
    spark, path = rows.sparkSession, scratch_path(rows.sparkSession, "cells")
    found = drawn_cells(rows, features, key, trees)
    found.write.partitionBy("arm", "block").parquet(path)
    stored = spark.read.schema(found.schema).parquet(path)
    arms = {r.arm: r for r in stored.where("block = 0").groupBy("arm").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("cells")).collect()}  # five arms
    learned = [i for i in range(len(ARMS)) if i in arms and arms[i].n >= least_rows]
    cells = {i: _assembled(stored.where(F.col("arm") == i).coalesce(-(-arms[i].cells // CELLS)), features) for i in learned}

    def grown(one: tuple[int, int]) -> list[float]:
        (i, tree), (block, j) = one, divmod(one[1], BLOCK)
        w, s = F.col(f"w{j}"), F.col(f"s{j}")
        drawn = cells[i].where((F.col("block") == block) & (w > 0)).select("__x", w.cast("double").alias("weight"), (s / w).alias("reward"))
        learner = RandomForestRegressor(featuresCol="__x", labelCol="reward", weightCol="weight", numTrees=1, maxDepth=depth, bootstrap=False, seed=SEED + i * trees + tree)
        return learner.setFeatureSubsetStrategy("onethird" if trees > 1 else "all").fit(drawn).featureImportances.toArray()

    each = [(i, t) for i in learned for t in range(trees)]
    with ThreadPool(2 * spark.sparkContext.defaultParallelism) as pool:
        of = dict(zip(each, pool.map(inheritable_thread_target(spark)(grown), each, chunksize=1)))
    out = _ranking(rows, features, [0.0] * len(features)).withColumn("arm", F.lit(-1)).where("false")
    for i in learned:
        total = sum(of[i, t] for t in range(trees))  # a tree's add up to 1, or to 0 if nothing splits
        out = out.unionByName(_ranking(rows, features, total / (total.sum() or 1.0)).withColumn("arm", F.lit(i)))
    return out


def propensity_pipeline(features: list[str], scaled: bool = False) -> Pipeline:
    """Indexer of the arm name, assembler and multinomial regression, to be fitted and saved."""
    stages = [StringIndexer(inputCol="difficulty_arm", outputCol="label", handleInvalid="keep"), VectorAssembler(inputCols=features, outputCol="raw_features", handleInvalid="keep")]
    column = "raw_features"
    if scaled:
        stages.append(StandardScaler(inputCol="raw_features", outputCol="scaled_features", withMean=True))
        column = "scaled_features"
    learner = LogisticRegression(featuresCol=column, labelCol="label", maxIter=500 if scaled else 50)
    return Pipeline(stages=[*stages, learner.setWeightCol("weight") if scaled else learner])


def balanced_weights(rows: DataFrame) -> DataFrame:
    """Weight n / (arms x rows of the arm), so that each arm weighs the same."""
    counts = rows.groupBy("difficulty_arm").count()
    total, k = counts.agg(F.sum("count"), F.count(F.lit(1))).first()
    return rows.join(counts, "difficulty_arm").withColumn("weight", F.lit(total) / (k * F.col("count"))).drop("count")


def logged_propensities(model: PipelineModel, rows: DataFrame) -> DataFrame:
    """``rows`` with label, the probability of each label, and logged_propensity, that of the arm taken."""
    scored = model.transform(rows).withColumn("label", F.col("label").cast("int")).withColumn("probabilities", vector_to_array("probability"))
    return scored.select(*rows.columns, "label", "probabilities", F.try_element_at("probabilities", F.col("label") + 1).alias("logged_propensity"))


def forest_propensities(train: DataFrame, rows: DataFrame, features: list[str], trees: int = 100, depth: int = 10) -> DataFrame:
    """``rows`` with pscore, the floored probability of the arm taken, by a forest on ``train``."""
    with _held(train, ["arm"], features) as held:
        model = RandomForestClassifier(featuresCol="__x", labelCol="arm", numTrees=trees, maxDepth=depth, seed=SEED, cacheNodeIds=True).fit(held)
    scored = model.transform(_assembled(rows, features)).withColumn("__p", vector_to_array("probability"))
    p = F.coalesce(F.try_element_at("__p", F.col("arm") + 1), F.lit(0.0))
    return scored.select(*rows.columns, F.greatest(p, F.lit(PROPENSITY_FLOOR)).alias("pscore"))


def reward_models(train: DataFrame, rows: DataFrame, features: list[str], least_rows: int = 10, trees: int = 100, depth: int = 10) -> DataFrame:
    """``rows`` with qhat, the expected reward of each arm; the global mean for arms with few rows."""
    with _held(train, ["arm", "reward"], features) as held:
        mean = held.agg(F.avg("reward")).first()[0] or 0.0
        counts = {r.arm: r["count"] for r in held.groupBy("arm").count().collect()}
        learner = lambda i: RandomForestRegressor(featuresCol="__x", labelCol="reward", predictionCol=f"__q{i}", numTrees=trees, maxDepth=depth, seed=SEED, cacheNodeIds=True)
        found = _fitted({i: learner(i) for i in range(len(ARMS)) if counts.get(i, 0) >= least_rows}, held)
    out, kept = _assembled(rows, features), rows.columns
    for i in range(len(ARMS)):
        out = found[i].transform(out) if i in found else out.withColumn(f"__q{i}", F.lit(float(mean)))
    return out.select(*kept, F.array(*[F.col(f"__q{i}") for i in range(len(ARMS))]).alias("qhat"))


def regression_loss(folds: DataFrame, features: list[str]) -> Callable[[dict, int], float]:
    """Loss for search.search: root mean squared error on fold k of a regularised regression of rewards learned on the other folds (column fold).

    ``params`` has penalty and mix (the share of it that is absolute). ``folds`` should be stored by fold, as each call reads them.
    """
    rows = _assembled(folds, features)

    def loss(params: dict, fold: int) -> float:
        model = LinearRegression(featuresCol="__x", labelCol="reward", regParam=params["penalty"], elasticNetParam=params["mix"]).fit(rows.where(F.col("fold") != fold))
        error = F.col("prediction") - F.col("reward")
        found = model.transform(rows.where(F.col("fold") == fold)).agg(F.sqrt(F.avg(error * error))).head()[0]  # one number
        return math.nan if found is None else found

    return loss
