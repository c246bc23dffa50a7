"""Quantiles of any range of days from small stored sketches, one for each day and column.

A sketch (KLL) is a summary of bounded size that Spark builds in one pass with partial aggregation; sketches of days merge into that of a
range, so a year of quantiles reads a few kilobytes a day instead of the rows. Up to K values are kept as they are, so
small tables give exact quantiles; beyond, ranks are right to about 2.3 / K^0.9 (0.1 % for the K here).
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestride.operators.quantiles import around, exact_quantiles

K = 4096
MARGIN = 0.002  # twice the error of a rank


def daily_sketches(rows: DataFrame, columns: list[str], by: str = "session_date", k: int = K) -> DataFrame:
    """One row for each day and column: the day, name, n (values that aren't null or NaN) and sketch (null without values)."""
    value = lambda c: F.when(~F.isnan(F.col(f"`{c}`").cast("double")), F.col(f"`{c}`").cast("double"))
    each = [F.struct(F.lit(c).alias("name"), F.col(f"n_{i}").alias("n"), F.col(f"s_{i}").alias("sketch")) for i, c in enumerate(columns)]
    days = rows.groupBy(by).agg(*[f for i, c in enumerate(columns) for f in (F.count(value(c)).alias(f"n_{i}"), F.kll_sketch_agg_double(value(c), F.lit(k)).alias(f"s_{i}"))])
    long = days.select(by, F.explode(F.array(*each)).alias("x")).select(by, "x.*")
    return long.withColumn("sketch", F.when(F.col("n") > 0, F.col("sketch")))


def quantiles(sketches: DataFrame, probabilities: list[float], start: date | None = None, end: date | None = None, by: str = "session_date", k: int = K) -> DataFrame:
    """name, n, p and value over the days from ``start`` to ``end``; columns without a value aren't there."""
    days = sketches.where(F.col("n") > 0)
    days = days if start is None else days.where(F.col(by) >= F.lit(start))
    days = days if end is None else days.where(F.col(by) <= F.lit(end))
    merged = days.groupBy("name").agg(F.sum("n").alias("n"), F.kll_merge_agg_double("sketch", F.lit(k)).alias("sketch"))
    ps = F.array(*[F.lit(float(p)) for p in probabilities])
    return merged.select("name", "n", F.explode(F.arrays_zip(ps.alias("p"), F.kll_sketch_get_quantile_double("sketch", ps).alias("value"))).alias("q")).select("name", "n", "q.p", "q.value")


def settled(rows: DataFrame, sketches: DataFrame, columns: list[str], probabilities: list[float], start: date, end: date, by: str = "session_date") -> DataFrame:
    """As quantiles, but exact for any number of values: the sketches tell where each quantile is, one pass over the rows of the days settles it."""
    near = quantiles(sketches, around(probabilities, MARGIN), start, end, by)
    cuts = near.groupBy("name").agg(F.collect_set("value").alias("cuts"))
    return exact_quantiles(rows.where(F.col(by).between(F.lit(start), F.lit(end))), columns, probabilities, cuts)
