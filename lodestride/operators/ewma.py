"""Exponentially weighted averages of each user's earlier rows, without Python.

y_1 = x_1, y_t = (1 - a) y_(t-1) + a x_t, shifted by one row; a null decays the weight of what
came before, and the result is 0 where nothing has. Each row is a linear map y -> keep y + add, so
rows are composed in blocks of BLOCK: a row folds the maps of whole blocks before its own and of the rows
before it in its block. Every earlier row counts, however long the history; a fold has a step for each BLOCK of them.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestride.config import EWMA_ALPHAS

BLOCK = 64


def name_of(column: str, alpha: float) -> str:
    """Tenths of alpha by their number, others with their digits: alpha3, alpha0_01."""
    tenths = round(alpha * 10)
    return f"ewma_{column}_alpha{tenths}" if abs(alpha * 10 - tenths) < 1e-9 else f"ewma_{column}_alpha{format(alpha, 'f').rstrip('0').replace('.', '_')}"


def _step(column: str, alpha: float) -> Column:
    """The map of a row: nothing for a null, the value itself for a user's first one. Also its parts: weight w of the value x, whether the row
    before had a value (plain: then it keeps 1 - alpha), and what it keeps else."""
    x, since = F.col(column).cast("double"), F.col("__rn") - F.col(f"__last_{column}")
    old = F.pow(F.lit(1 - alpha), since)
    weight = alpha / (old + alpha)
    empty = x.isNull() | F.isnan(x)
    keep = F.when(empty, 1.0).when(since.isNull(), 0.0).otherwise(1 - weight)
    add = F.when(empty, 0.0).when(since.isNull(), x).otherwise(weight * x)
    w = F.when(empty, 0.0).when(since.isNull(), 1.0).when(since == 1, alpha).otherwise(weight)
    plain = F.coalesce(~empty & (since == 1), F.lit(False))
    return F.struct(keep.alias("keep"), add.alias("add"), w.alias("w"), F.when(empty, 0.0).otherwise(x).alias("x"), plain.cast("int").alias("plain"), F.when(plain, 1.0).otherwise(keep).alias("other"))


def add_ewma(rows: DataFrame, columns: list[str], alphas: tuple[float, ...] = EWMA_ALPHAS, pairs: list[tuple[str, float]] | None = None) -> DataFrame:
    """``rows`` with an average (name_of) for all columns and alphas, or for ``pairs`` alone."""
    wanted, kept = pairs or [(c, a) for c in columns for a in alphas], rows.columns
    by_user = Window.partitionBy("user_id").orderBy("session_date")
    earlier = by_user.rowsBetween(Window.unboundedPreceding, -1)
    in_block = Window.partitionBy("user_id", "__block").orderBy("__rn").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("__rn", F.row_number().over(by_user) - 1)
    used = dict.fromkeys(c for c, _ in wanted)
    rows = rows.withColumns({f"__last_{c}": F.last(F.when(F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double")), F.col("__rn")), ignorenulls=True).over(earlier) for c in used})
    rows = rows.withColumn("__map", F.array(*[_step(c, a) for c, a in wanted])).withColumn("__block", F.floor(F.col("__rn") / BLOCK))
    rows = rows.withColumn("__inside", F.collect_list("__map").over(in_block))
    start = F.struct(F.lit(1.0).alias("keep"), F.lit(0.0).alias("add"))
    both = lambda i: lambda s, m: F.struct((s["keep"] * m[i]["keep"]).alias("keep"), (s["add"] * m[i]["keep"] + m[i]["add"]).alias("add"))
    whole = F.array(*[F.aggregate(F.concat("__inside", F.array("__map")), start, both(i)) for i in range(len(wanted))])
    rows = rows.withColumn("__whole", F.when(F.col("__rn") % BLOCK == BLOCK - 1, whole))
    rows = rows.withColumn("__before", F.collect_list("__whole").over(Window.partitionBy("user_id").orderBy("__rn").rowsBetween(Window.unboundedPreceding, -1)))
    return rows.select(*kept, *[_average(i, a).alias(name_of(c, a)) for i, (c, a) in enumerate(wanted)])


def _average(i: int, alpha: float) -> Column:
    """The sum of weight x (1 - alpha)^k x value over the rows of the block, the latest first, and of what came before the block.

    In this order and with powers, not products, the sum has the bits of the closed form in SQL, so values that end halfway between two
    decimals are rounded the same way. (Beyond a block of rows the two agree but for the last bits.)
    """
    older = F.aggregate("__before", F.lit(0.0), lambda y, m: y * m[i]["keep"] + m[i]["add"])
    powers = F.array(*[F.lit(math.pow(1 - alpha, k)) for k in range(BLOCK)])  # of the C library, whose last bit is not always Java's
    decay = lambda s: F.get(powers, s["k"]) * s["rest"]
    start = F.struct(F.lit(0.0).alias("sum"), F.lit(0).alias("k"), F.lit(1.0).alias("rest"))
    add = lambda s, m: F.struct((s["sum"] + m[i]["w"] * decay(s) * m[i]["x"]).alias("sum"), (s["k"] + m[i]["plain"]).alias("k"), (s["rest"] * m[i]["other"]).alias("rest"))
    return F.aggregate(F.reverse("__inside"), start, add, lambda s: s["sum"] + decay(s) * older)


def advance(state: DataFrame | None, rows: DataFrame, columns: list[str], alphas: tuple[float, ...] = EWMA_ALPHAS, pairs: list[tuple[str, float]] | None = None) -> tuple[DataFrame, DataFrame]:
    """The averages of ``rows`` (user_id, session_date and name_of each pair), and the new states of their users, from stored states and ``rows`` alone.

    A state is a row for each user: the names of its averages, the day of the last row, the average of everything so far (null before
    the first value) and, for each column, rows since its last value. It is all that later days need, so a day costs its own rows, not the
    history. Users without rows keep their states, so the new states are to be merged by user_id. ``state`` None begins a history.
    Rows must be later than their user's state, and a state must have the names that are asked for; both are errors else.
    """
    wanted = pairs or [(c, a) for c in columns for a in alphas]
    names, used = [name_of(c, a) for c, a in wanted], list(dict.fromkeys(c for c, _ in wanted))
    value = lambda c: F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double"))
    days = rows.groupBy("user_id").agg(F.array_sort(F.collect_list(F.struct("session_date", F.array(*map(value, used)).alias("x")))).alias("days"))
    if state is None:
        state = rows.sparkSession.createDataFrame([], f"user_id {rows.schema['user_id'].dataType.simpleString()}, names array<string>, last_date date, y array<double>, gap array<int>")
    joined = days.join(state.select(F.col("user_id").alias("__user"), *STATE), F.col("user_id").eqNullSafe(F.col("__user")), "left").drop("__user")
    known, first = F.array(*map(F.lit, names)), F.col("days")[0]["session_date"]
    checked = F.when(F.col("names").isNotNull() & (F.col("names") != known), F.raise_error(F.lit("the state has other averages"))).when(first <= F.col("last_date"), F.raise_error(F.lit("the state is not older than the rows")))
    empty = lambda n, kind: F.array(*[F.lit(None).cast(kind)] * n)
    start = F.struct(F.coalesce(checked.cast("array<double>"), "y", empty(len(names), "double")).alias("y"), F.coalesce("gap", empty(len(used), "int")).alias("gap"), F.array().cast("array<array<double>>").alias("out"))
    alpha, of = F.array(*[F.lit(a) for _, a in wanted]), F.array(*[F.lit(used.index(c)) for c, _ in wanted])

    def step(s, day):
        def average(y, i):
            x, a = F.get(day["x"], F.get(of, i)), F.get(alpha, i)
            old = F.pow(1 - a, F.get(s["gap"], F.get(of, i)))
            return F.when(x.isNull(), y).when(y.isNull(), x).otherwise(old / (old + a) * y + a / (old + a) * x)

        gap = F.transform(s["gap"], lambda g, j: F.when(F.get(day["x"], j).isNull(), g + 1).otherwise(1))
        return F.struct(F.transform(s["y"], average).alias("y"), gap.alias("gap"), F.concat(s["out"], F.array(s["y"])).alias("out"))

    folded = joined.select("user_id", "days", F.aggregate("days", start, step).alias("s"))
    each = folded.select("user_id", F.explode(F.arrays_zip(F.col("days.session_date").alias("session_date"), F.col("s.out").alias("y"))).alias("r"))
    averages = each.select("user_id", "r.session_date", *[F.coalesce(F.get("r.y", F.lit(i)), F.lit(0.0)).alias(n) for i, n in enumerate(names)])
    return averages, folded.select("user_id", known.alias("names"), F.element_at("days", -1)["session_date"].alias("last_date"), "s.y", "s.gap")


STATE = ("names", "last_date", "y", "gap")


def compare(stored: DataFrame, recomputed: DataFrame, columns: list[str], tolerance: float = 1e-10) -> DataFrame:
    """Per column: largest, mean and summed absolute difference, rows, and whether it passes; one pass."""
    a, b = stored.alias("a"), recomputed.alias("b")
    joined = a.join(b, [F.col("a.user_id") == F.col("b.user_id"), F.col("a.session_date") == F.col("b.session_date")])
    diffs = joined.select(F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), F.abs(F.col(f"a.`{c}`") - F.col(f"b.`{c}`")).alias("d")) for c in columns])).alias("x"))
    out = diffs.groupBy("x.feature").agg(F.max("x.d").alias("max_diff"), F.avg("x.d").alias("mean_diff"), F.sum("x.d").alias("sum_diff"), F.count("x.d").alias("n"))
    return out.withColumn("passed", F.col("max_diff") < tolerance)
