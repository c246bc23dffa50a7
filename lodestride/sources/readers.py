"""Readers: files by format, JDBC, tables, dated table names, training text."""

from __future__ import annotations

import re
from datetime import date

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestride.sources.delta import read_delta

JDBC_PARTITIONS, JDBC_FETCH = 20, 10_000
DATED = re.compile(r"_(\d{4})[_-](\d{2})[_-](\d{2})")

EVENT_SCHEMA = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("props", T.StringType()),
    ]
)


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path is there, on any file system that Spark reads."""
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(jvm_path)


def format_of(spark: SparkSession, path: str) -> str:
    """delta for a folder with a transaction log; else by the suffix; else parquet."""
    if exists(spark, f"{path.rstrip('/')}/_delta_log"):
        return "delta"
    return next((f for f in ("parquet", "csv", "json", "orc", "delta") if path.rstrip("/").endswith(f".{f}")), "parquet")


def read_files(spark: SparkSession, path: str, fmt: str | None = None, schema: T.StructType | None = None) -> DataFrame:
    """Files of a format, found by format_of; CSV has a header and no inferred types.

    A table with a transaction log is read by its source where that is installed, else as the snapshot that the log gives
    (sources.delta). The helper column ``partition_key`` is dropped, if there.
    """
    fmt = fmt or format_of(spark, path)
    reader = spark.read.schema(schema) if schema is not None else spark.read
    if fmt == "csv":
        reader = reader.option("header", True)
    try:
        return reader.format(fmt).load(path).drop("partition_key")
    except (AnalysisException, Py4JJavaError) as missing:
        if fmt != "delta" or not re.search("DATA_SOURCE_NOT_FOUND|Failed to find the data source|ClassNotFound", str(missing)):
            raise
        return read_delta(spark, path).drop("partition_key")


def read_checkpoint(spark: SparkSession, path: str) -> DataFrame:
    """A frame written by writers.write_checkpoint, named with or without its suffix."""
    bare = path.rstrip("/").removesuffix(".parquet")
    found = next((p for p in (path, f"{bare}.parquet", bare) if exists(spark, p)), None)
    if found is None:
        raise FileNotFoundError(path)
    return spark.read.parquet(found)


def merged_with_first(base: DataFrame, other: DataFrame, keys: list[str]) -> DataFrame:
    """``base`` with the columns of ``other`` by ``keys`` where it has a row; of columns in both, that of ``base`` stays."""
    fresh = [c for c in other.columns if c not in base.columns]
    return base.join(other.dropDuplicates(keys).select(*keys, *fresh), keys, "left").select(*base.columns, *fresh)


def read_jdbc(spark: SparkSession, url: str, table: str, key: str, start: str, end: str, date_column: str, hash_sql: str = "HASH({key})", **options: str) -> DataFrame:
    """Parallel scan of a date range: one predicate per hash partition, evaluated at the source. ``hash_sql`` is the source's whole-number hash of a key that isn't null."""
    bucket = f"MOD(ABS({hash_sql.format(key=key)}), {JDBC_PARTITIONS})"
    predicates = [f"({bucket} = {i}{f' OR {key} IS NULL' if i == 0 else ''}) AND {date_column} BETWEEN '{start}' AND '{end}'" for i in range(JDBC_PARTITIONS)]
    properties = {"fetchsize": str(JDBC_FETCH)} | options
    return spark.read.jdbc(url, table, predicates=predicates, properties=properties)


def read_query(spark: SparkSession, fmt: str, query: str, **options: str) -> DataFrame:
    """Rows of a query that the connector ``fmt`` pushes to its source."""
    return spark.read.format(fmt).options(**options).option("query", query).load()


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def date_of(table_name: str) -> date | None:
    """Date in a name such as events_2024_01_31."""
    m = DATED.search(table_name)
    return date(*map(int, m.groups())) if m else None


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """Training text as one ``record`` per block; blocks are parted by a blank line."""
    return spark.read.option("lineSep", "\n\n").text(path).withColumnRenamed("value", "record").where(F.trim("record") != "")


def layered(*layers: dict) -> dict:
    """Settings by precedence: earlier layers win, None is unset."""
    out: dict = {}
    for layer in reversed(layers):
        out |= {k: v for k, v in layer.items() if v is not None}
    return out
