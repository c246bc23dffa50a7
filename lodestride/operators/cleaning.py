"""Profiles, filters, scaling and splits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestride.config import QUANTILE_ACCURACY, TRAIN_PERCENT, VALID_PERCENT, WINSOR_QUANTILE
from lodestride.functions.arms import md5_bucket
from lodestride.operators.quantiles import exact_quantiles

LEAK = "action"  # the change of the multiplier is the label


def numeric_columns(df: DataFrame, exclude: tuple[str, ...] = ()) -> list[str]:
    """Numeric features; ids, targets and columns of the next row are left out."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType) and f.name not in exclude and not f.name.startswith("next_")]


def column_profile(df: DataFrame, columns: list[str]) -> DataFrame:
    """Share of nulls and zeros of each column, and whether it is to be dropped; one pass."""
    stats = df.agg(
        F.count(F.lit(1)).alias("n"),
        *[F.sum(F.col(c).isNull().cast("long")).alias(f"{c}__null") for c in columns],
        *[F.sum((F.coalesce(F.col(c).try_cast("double"), F.lit(1.0)) == 0).cast("long")).alias(f"{c}__zero") for c in columns],
    )
    rows = stats.select(F.explode(F.array(*[F.struct(F.lit(c).alias("name"), F.col("n"), F.col(f"{c}__null").alias("nulls"), F.col(f"{c}__zero").alias("zeros")) for c in columns])).alias("r")).select("r.*")
    return rows.withColumn("dropped", (F.col("nulls") == F.col("n")) | (F.col("zeros") >= 0.99 * F.col("n")))


def lower_cased(df: DataFrame) -> DataFrame:
    """All column names in lower case, and userid as user_id."""
    names = [c.lower() for c in df.columns]
    return df.toDF(*["user_id" if c == "userid" and "user_id" not in names else c for c in names])


def without_dead_columns(df: DataFrame, keep: tuple[str, ...] = ("user_id", "session_date")) -> DataFrame:
    """``df`` without columns that are null throughout, or numeric and 0 in 99 % of the rows. Reads the table once, as the schema depends on it."""
    dead = {r.name for r in column_profile(df, [c for c in df.columns if c not in keep]).where("dropped").collect()}  # names of columns
    return df.drop(*dead)


def selected(df: DataFrame, names: list[str], required: tuple[str, ...] = ()) -> DataFrame:
    """Required columns and those named in the whitelist, in any case, in the order of ``df``; a column that gives away the label never passes."""
    asked = {n.upper() for n in names} - {LEAK.upper()}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c in required or (c.upper() in asked and c != LEAK)])


def without_leaks(names: list[str]) -> list[str]:
    return [n for n in names if n.lower() != LEAK]


def distinct_values(df: DataFrame, column: str, most: int = 100) -> list[str]:
    """Values of a column of few values, ascending, without null; an error beyond ``most``."""
    found = [r[0] for r in df.select(F.col(column).cast("string")).where(F.col(column).isNotNull()).distinct().limit(most + 1).collect()]
    if len(found) > most:
        raise ValueError(f"{column} has more than {most} values")
    return sorted(found)


def encoded(df: DataFrame, keep: tuple[str, ...] = ("user_id", "difficulty_arm", "session_date")) -> DataFrame:
    """All string columns one-hot by the values that are there (null gives 0 everywhere), timestamps dropped, numbers filled with 0."""
    for f in list(df.schema.fields):
        if f.name in keep:
            continue
        if isinstance(f.dataType, T.StringType):
            df = one_hot(df, f.name, distinct_values(df, f.name)).drop(f.name)
        elif isinstance(f.dataType, T.TimestampType | T.TimestampNTZType):
            df = df.drop(f.name)
    return df.fillna(0, subset=numeric_columns(df, exclude=keep)) if numeric_columns(df, exclude=keep) else df


def sampled(df: DataFrame, fraction: float = 0.01, seed: int = 42) -> DataFrame:
    """A Bernoulli sample without replacement."""
    return df.sample(False, fraction, seed)


def average_row_bytes(df: DataFrame) -> DataFrame:
    """Rows and the average size of one as JSON."""
    return df.agg(F.count(F.lit(1)).alias("n"), F.avg(F.length(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns])))).alias("avg_bytes"))


def winsorized(df: DataFrame, column: str, quantile: float = WINSOR_QUANTILE) -> DataFrame:
    """Values over the quantile (the exact one) are set to it; the cap is a scalar subquery."""
    cap = exact_quantiles(df, [column], [quantile]).select(F.col("value").cast(df.schema[column].dataType)).scalar()
    return df.withColumn(column, F.least(F.col(column), cap))


def filled(df: DataFrame, columns: list[str]) -> DataFrame:
    """Infinite, NaN and null values as 0."""
    clean = lambda c: F.when(F.abs(c.cast("double")) < float("inf"), c.cast("double")).otherwise(0.0)
    return df.withColumns({c: clean(F.col(c)) for c in columns})


def minmax_scaled(train: DataFrame, df: DataFrame, columns: list[str]) -> DataFrame:
    """[0, 1] by the minima and maxima of ``train`` alone, clipped; constant columns are 0."""
    out = {}
    stats = train.agg(*[f(F.col(c).cast("double")).alias(f"{c}__{f.__name__}") for c in columns for f in (F.min, F.max)])
    for c in columns:
        low, high = stats.select(f"{c}__min").scalar(), stats.select(f"{c}__max").scalar()
        scaled = F.greatest(F.lit(0.0), F.least(F.lit(1.0), (F.col(c) - low) / (high - low)))
        out[c] = F.when(low.isNull() | (high == low), 0.0).otherwise(scaled)
    return df.withColumns(out)


def one_hot(df: DataFrame, column: str, values: list[str]) -> DataFrame:
    """One 0/1 column per value; null gives 0 everywhere."""
    return df.withColumns({f"{column}_{v}": F.coalesce((F.col(column) == v).cast("int"), F.lit(0)) for v in values})


def split_of(bucket: Column) -> Column:
    return F.when(bucket < TRAIN_PERCENT, "train").when(bucket < VALID_PERCENT, "validation").otherwise("test")


def user_split(df: DataFrame, seed: int = 42, portable: bool = False) -> DataFrame:
    """Split of each row by a hash of its user: Spark's hash, or md5 (``portable``)."""
    bucket = md5_bucket(F.concat(F.col("user_id").cast("string"), F.lit(f"_{seed}"))) if portable else F.pmod(F.abs(F.hash("user_id")) + seed, F.lit(100))
    return df.withColumn("split", split_of(bucket))


def user_folds(df: DataFrame, k: int = 5, portable: bool = False) -> DataFrame:
    bucket = md5_bucket(F.col("user_id")) if portable else F.abs(F.hash("user_id"))
    return df.withColumn("fold", F.pmod(bucket, F.lit(k)).cast("int"))


CELLS = 4096  # of a bin's hashes


def stratified_split(df: DataFrame, value: str, bins: int = 5, seed: int = 42) -> DataFrame:
    """Users in quantile bins of their mean value, each bin dealt exactly: 80 % (rounded down) train, 10 % (rounded down) validation, the rest test.

    A bin is dealt in the order of a hash of its users, without a sort of all of them: a histogram of the hashes (CELLS cells a bin,
    so a table of fixed size) tells which cell each quota ends in, whole cells before and after it are dealt by their
    counts, and only users in such a cell are ranked. The bin bounds are a few quantiles (rank error of 1 in 10,000).
    """
    users = df.groupBy("user_id").agg(F.round(F.avg(value), 6).alias("mean_value"))
    at = F.array(*[F.lit(i / bins) for i in range(1, bins)])
    bounds = users.agg(F.percentile_approx("mean_value", at, F.lit(QUANTILE_ACCURACY)).alias("q")).scalar()
    hashed = F.conv(F.substring(F.md5(F.concat_ws("_", F.coalesce(F.col("user_id").cast("string"), F.lit("")), F.lit(str(seed)))), 1, 15), 16, 10).cast("long")
    users = users.withColumn("__q", bounds).select(
        "user_id", "mean_value", F.aggregate("__q", F.lit(1), lambda n, q: n + F.when(F.col("mean_value") > q, 1).otherwise(0)).alias("bin"), hashed.alias("__h")
    )
    users = users.withColumn("__cell", F.shiftright("__h", 60 - CELLS.bit_length() + 1).cast("int"))
    cells = users.groupBy("bin", "__cell").agg(F.count(F.lit(1)).alias("__n"))
    upto = F.sum("__n").over(Window.partitionBy("bin").orderBy("__cell"))
    total = F.sum("__n").over(Window.partitionBy("bin"))
    cells = cells.withColumns({"__end": upto, "__total": total}).withColumns({"__start": F.col("__end") - F.col("__n"), "__train": F.floor(F.col("__total") * 8 / 10)})
    cells = cells.withColumn("__valid", F.col("__train") + F.floor(F.col("__total") / 10))
    inside = lambda q: (F.col("__start") < F.col(q)) & (F.col(q) < F.col("__end"))
    placed = users.join(F.broadcast(cells.withColumn("__cut", inside("__train") | inside("__valid"))), ["bin", "__cell"])  # at most bins x CELLS rows
    ranked = placed.where("__cut").withColumn("__start", F.col("__start") + F.row_number().over(Window.partitionBy("bin", "__cell").orderBy("__h", "user_id")) - 1)
    dealt = placed.where("NOT __cut").unionByName(ranked)
    split = F.when(F.col("__start") < F.col("__train"), "train").when(F.col("__start") < F.col("__valid"), "validation").otherwise("test")
    return dealt.select("user_id", "mean_value", "bin", split.alias("split"))
