"""Rows that models are fitted on: found once, on all cores."""

from pyspark.sql import functions as F

from lodestride.operators import models


def table(spark, n=2400):
    return spark.range(n, numPartitions=1).select(F.col("id").alias("user_id"), (F.col("id") % 4).cast("int").alias("arm"), (F.col("id") % 7).cast("double").alias("x"), (F.col("id") % 11).cast("double").alias("y"), (F.col("id") % 7 * 3.0).alias("reward"))


def test_fits_read_held_rows_on_all_cores(spark, monkeypatch):
    seen, fit = [], models.RandomForestRegressor.fit

    def watched(self, rows):
        seen.append((rows.rdd.getNumPartitions(), "InMemoryTableScan" in rows._jdf.queryExecution().executedPlan().toString(), rows.count()))
        return fit(self, rows)

    monkeypatch.setattr(models.RandomForestRegressor, "fit", watched)
    rows = table(spark)
    out = models.arm_importances(rows, ["x", "y"], trees=3, depth=3)
    assert seen == [(spark.sparkContext.defaultParallelism, True, 600)] * 4
    assert {r["arm"]: round(r["s"], 6) for r in out.groupBy("arm").agg(F.sum("importance").alias("s")).collect()} == dict.fromkeys(range(4), 1.0)
    got = models.reward_models(rows, rows, ["x", "y"], trees=3, depth=3)
    assert got.columns == [*rows.columns, "qhat"] and got.where(F.size("qhat") == 5).count() == 2400 and len(seen) == 8
