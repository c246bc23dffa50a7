"""Forests over many rows: drawn once into cells of equal features, on which trees grow."""

import math

import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import functions as F

from lodestride.operators import models


def table(spark, n=6000):
    x, y = F.pmod(F.hash("id"), F.lit(7)), F.pmod(F.hash(F.col("id") * 3), F.lit(5))
    return spark.range(n, numPartitions=3).select("id", (F.col("id") % 4).cast("int").alias("arm"), x.alias("x"), y.alias("y"), (x * x + 5 * y + F.pmod(F.hash(F.col("id") + 1), F.lit(10))).cast("double").alias("reward"))


def test_forests_of_many_rows_grow_on_cells(spark, monkeypatch):
    seen, fit = [], models.RandomForestRegressor.fit

    def watched(self, rows):
        seen.append((self.getNumTrees(), self.getBootstrap(), rows.count() <= 35))
        return fit(self, rows)

    monkeypatch.setattr(models.RandomForestRegressor, "fit", watched)
    rows = table(spark)
    over_rows = models.arm_importances(rows, ["x", "y"], trees=20, depth=6, key=["id"])
    assert [s[0] for s in seen] == [20] * 4
    monkeypatch.setattr(models, "HELD", 100_000)
    seen.clear()
    over_cells = models.arm_importances(rows, ["x", "y"], trees=20, depth=6, key=["id"])
    assert seen == [(1, False, True)] * 80
    a, b = ({(r.arm, r.feature): r.importance for r in out.collect()} for out in (over_rows, over_cells))
    assert a.keys() == b.keys() and len(b) == 8 and all(abs(a[k] - b[k]) < 0.05 for k in a)
    assert all(math.isclose(b[i, "x"] + b[i, "y"], 1.0) for i in range(4))
    seen.clear()
    assert models.arm_importances(rows, ["x", "y"], trees=20, depth=6, least_rows=1501, key=["id"]).count() == 0 and not seen


def test_a_tree_on_cells_splits_as_on_rows(spark):
    rows = table(spark).where("arm = 0")
    alone = models.drawn_cells(rows, ["x", "y", "id"], ["id"], 20)  # each row is a cell of its own
    cells = models.drawn_cells(rows.repartition(5), ["x", "y"], ["id"], 20)
    for block, j in ((0, 0), (0, 15), (1, 3)):
        got = []
        for found in (alone, cells):
            drawn = found.where(f"block = {block} AND w{j} > 0").select("x", "y", F.col(f"w{j}").cast("double").alias("weight"), F.expr(f"s{j} / w{j}").alias("reward"))
            model = RandomForestRegressor(featuresCol="f", labelCol="reward", weightCol="weight", numTrees=1, maxDepth=8, bootstrap=False, featureSubsetStrategy="all").fit(VectorAssembler(inputCols=["x", "y"], outputCol="f").transform(drawn))
            got.append((model.trees[0].numNodes, [round(v, 9) for v in model.featureImportances.toArray()]))
        assert got[0] == got[1] and got[0][0] > 30


def test_each_row_is_drawn_for_each_tree(spark):
    rows = spark.range(20000).select("id", F.lit(0).alias("arm"), F.lit(2.0).alias("reward"), F.lit(1).alias("x"))
    alone = models.drawn_cells(rows.withColumn("row", F.col("id")), ["x", "row"], ["id"], 32).drop("row")
    at = [F.avg(f"w{j}").alias(f"m{j}") for j in range(16)] + [F.var_pop(f"w{j}").alias(f"v{j}") for j in range(16)] + [F.avg((F.col(f"w{j}") == 0).cast("int")).alias(f"z{j}") for j in range(16)]
    at += [F.corr(f"w{i}", f"w{j}").alias(f"c{i}_{j}") for i, j in ((0, 1), (0, 4), (3, 15), (7, 8))]
    for r in alone.groupBy("block").agg(F.count(F.lit(1)).alias("rows"), *at).collect():
        assert r["rows"] == 20000
        assert all(abs(r[f"m{j}"] - 1) < 0.04 and abs(r[f"v{j}"] - 1) < 0.06 and abs(r[f"z{j}"] - math.exp(-1)) < 0.02 for j in range(16))
        assert all(abs(r[c]) < 0.04 for c in r.asDict() if c.startswith("c"))
    cell = models.drawn_cells(rows, ["x"], ["id"], 32).collect()
    assert len(cell) == 2 and all(r["n"] == 20000 and r[f"s{j}"] == 2.0 * r[f"w{j}"] for r in cell for j in range(16))
    assert len({r[f"w{j}"] for r in cell for j in range(16)}) > 20


def test_a_missing_reward_is_an_error(spark):
    rows = spark.range(3).select("id", F.lit(0).alias("arm"), F.when(F.col("id") > 0, 1.0).alias("reward"), F.lit(1).alias("x"))
    with pytest.raises(Exception, match="a reward is missing"):
        models.drawn_cells(rows, ["x"], ["id"], 4).collect()
