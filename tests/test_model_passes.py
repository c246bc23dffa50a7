"""How often models go over their rows."""

from functools import partial
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from lodestride.operators import models
from lodestride.plans import QUERIES, catalogue

SF = Path("/root/testdata/sf0.001")


def test_boosting_holds_no_nodes(spark, monkeypatch):
    seen, fit = [], models.GBTRegressor.fit

    def short(self, rows):
        kept = [fit(self.copy({self.maxIter: 3, self.cacheNodeIds: c}), rows).toDebugString.split("\n", 1)[1] for c in (False, True)]
        seen.append((self.getCacheNodeIds(), self.getMaxIter(), self.getMaxDepth(), kept[0] == kept[1]))
        return fit(self.copy({self.maxIter: 3}), rows)

    monkeypatch.setattr(models.GBTRegressor, "fit", short)
    rows = spark.range(1200).select(F.pmod(F.col("id"), F.lit(2)).cast("int").alias("arm"), F.pmod(F.hash("id"), F.lit(50)).cast("double").alias("x"), (F.col("id") % 11).cast("double").alias("y"))
    out = models.arm_importances(rows.withColumn("reward", F.col("x") * F.col("y")), ["x", "y"], boosted=True)
    assert seen == [(False, 100, 6, True)] * 2 and out.count() == 4


@pytest.mark.parametrize("name, step, columns", [("forest_propensities", "forest_propensities", ["user_id", "session_date", "arm", "pscore"]), ("ope_with_reward_models", "reward_models", ["dr", "n"])])
def test_scoring_reads_stored_rows(spark, monkeypatch, name, step, columns):
    monkeypatch.setattr(models, step, partial(getattr(models, step), trees=2, depth=2))
    out = QUERIES[name](spark, str(SF))
    files = out.inputFiles()
    assert files and not any("events.parquet" in f for f in files)
    assert out.columns == columns
    held_out = catalogue.cleaning.user_folds(catalogue.model_rows(spark, str(SF)), portable=True).where("fold = 0")
    assert (out.first()["n"] if "n" in columns else out.count()) == held_out.count() > 0


def test_classifying_forest_reads_held_rows(spark, monkeypatch):
    seen, fit = [], models.RandomForestClassifier.fit

    def watched(self, rows):
        seen.append((rows.rdd.getNumPartitions(), "InMemoryTableScan" in rows._jdf.queryExecution().executedPlan().toString(), rows.count()))
        return fit(self, rows)

    monkeypatch.setattr(models.RandomForestClassifier, "fit", watched)
    rows = spark.range(1200, numPartitions=1).select((F.col("id") % 4).cast("int").alias("arm"), (F.col("id") % 7).cast("double").alias("x"), (F.col("id") % 11).cast("double").alias("y"))
    out = models.forest_importances(rows, ["x", "y"], trees=3, depth=3)
    assert seen == [(spark.sparkContext.defaultParallelism, True, 1200)]
    assert out.count() == 2
