"""Exact quantiles of large tables: an approximate answer shuts each in a narrow range of values, and counts settle it.

Cuts on either side of each rank part the values into buckets. The buckets' sizes are exact, so they tell which bucket a rank is in, and only the
distinct values of that bucket are ranked (a few in 10,000 of the rows). The result doesn't depend on how good the cuts are: poor ones
make the bucket larger, not the value wrong.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lodestride.config import QUANTILE_ACCURACY

MARGIN = 2 / QUANTILE_ACCURACY


def _named(rows: DataFrame, columns: list[str]) -> DataFrame:
    """name and value of each value that isn't null or NaN."""
    each = F.array(*[F.struct(F.lit(c).alias("name"), F.col(f"`{c}`").cast("double").alias("value")) for c in columns])
    return rows.select(F.explode(each).alias("r")).select("r.*").where("value IS NOT NULL AND NOT isnan(value)")


def around(probabilities: list[float], margin: float) -> list[float]:
    """Ranks on either side of each probability."""
    return sorted({min(1.0, max(0.0, p + side)) for p in probabilities for side in (-margin, margin)})


def exact_quantiles(rows: DataFrame, columns: list[str], probabilities: list[float], cuts: DataFrame | None = None) -> DataFrame:
    """name, n (values), p and value: the smallest value that at least a share p of the values doesn't exceed; columns without a value aren't there.

    ``cuts`` (name and an array cuts) may come from stored sketches; else they are found in the rows.
    """
    long = _named(rows, columns)
    if cuts is None:
        ranks = F.array(*[F.lit(x) for x in around(probabilities, MARGIN)])
        cuts = long.groupBy("name").agg(F.percentile_approx("value", ranks, F.lit(QUANTILE_ACCURACY)).alias("cuts"))
    cuts = cuts.select("name", F.array_sort("cuts").alias("cuts"))
    counted = long.groupBy("name", "value").agg(F.count(F.lit(1)).alias("c"))
    placed = counted.join(F.broadcast(cuts), "name").withColumn("bucket", F.size(F.filter("cuts", lambda x: x < F.col("value"))))
    # A few buckets a column, each with the cuts that bound it: sketches are random, so the cuts are found once and go along.
    edge = lambda i: F.get("cuts", i)
    sizes = placed.groupBy("name", "bucket", edge(F.col("bucket") - 1).alias("low"), edge(F.col("bucket")).alias("high")).agg(F.sum("c").alias("c"))
    sizes = sizes.withColumns({"upto": F.sum("c").over(Window.partitionBy("name").orderBy("bucket")), "n": F.sum("c").over(Window.partitionBy("name"))}).withColumn("start", F.col("upto") - F.col("c"))
    rank = lambda p: F.greatest(F.lit(1), F.ceil(F.col("n").cast("decimal(19,0)") * F.lit(Decimal(str(p)))).cast("long"))
    asked = sizes.withColumn("q", F.explode(F.array(*[F.struct(F.lit(float(p)).alias("p"), rank(p).alias("rank")) for p in probabilities])))
    asked = asked.where("start < q.rank AND q.rank <= upto").select("name", "low", "high", "n", "start", "q.p", "q.rank")
    inside = counted.join(F.broadcast(asked), "name").where("(low IS NULL OR value > low) AND (high IS NULL OR value <= high)")
    upto = F.col("start") + F.sum("c").over(Window.partitionBy("name", "p").orderBy("value"))
    return inside.withColumn("upto", upto).where("upto >= rank").groupBy("name", "n", "p").agg(F.min("value").alias("value"))
