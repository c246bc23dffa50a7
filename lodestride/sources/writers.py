"""Writers: partitioned tables, training text, bulk key-value sinks."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_FILE_RECORDS = 1_000_000


def write_partitioned(df: DataFrame, path: str, by: str = "session_date", mode: str = "overwrite") -> None:
    """overwrite, append, or replace: only the partitions that ``df`` has are replaced."""
    writer = df.write.partitionBy(by).option("maxRecordsPerFile", MAX_FILE_RECORDS).option("compression", "snappy")
    if mode == "replace":
        writer = writer.option("partitionOverwriteMode", "dynamic")
    writer.mode("append" if mode == "append" else "overwrite").parquet(path)


def replace_days(df: DataFrame, path: str, start: date, end: date, by: str = "session_date") -> None:
    """All days from ``start`` to ``end`` become those of ``df``, also where it has none; other days stay. Rows outside the range are an error."""
    spark = df.sparkSession
    days = {str(r[0]) for r in df.select(by).distinct().collect()}  # one value a day
    if any(not str(start) <= x <= str(end) for x in days):
        raise ValueError(f"rows outside {start} to {end}")
    write_partitioned(df, path, by, "replace")
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    for status in files.listStatus(folder):
        name, _, day = status.getPath().getName().partition("=")
        if name == by and str(start) <= day <= str(end) and day not in days:
            files.delete(status.getPath(), True)


def write_checkpoint(df: DataFrame, path: str) -> DataFrame:
    """``df`` as Parquet under ``path`` (with its suffix), read again: its lineage is cut."""
    path = f"{path.rstrip('/').removesuffix('.parquet')}.parquet"
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def write_report(df: DataFrame, path: str, fmt: str = "json") -> None:
    """A small result as one JSON or CSV file."""
    writer = df.coalesce(1).write.mode("overwrite")
    writer.option("header", True).csv(path) if fmt == "csv" else writer.json(path)


def write_records(df: DataFrame, path: str) -> None:
    """The ``record`` column as text, in as many shards as the rows have partitions."""
    df.select("record").write.mode("overwrite").text(path)


def write_splits(df: DataFrame, path: str, table_path: str | None = None) -> None:
    """One folder of text per split, in one pass over ``df`` (columns split and record); with ``table_path``, all columns as a table by split, too."""
    df.select("split", "record").write.mode("overwrite").partitionBy("split").text(path)
    if table_path is not None:
        df.drop("record").write.mode("overwrite").partitionBy("split").parquet(table_path)


def write_test_split(df: DataFrame, path: str, ratio: float = 0.1, seed: int = 42, files: int = 64) -> None:
    """Rows of users in the last hash buckets."""
    least = round((1 - ratio) * 100)
    rows = df.where(F.pmod(F.abs(F.hash("user_id")) + seed, F.lit(100)) >= least)
    rows.repartition(files).write.mode("overwrite").parquet(path)


def sink_partitions(rows: int, each: int = 100_000, least: int = 1, most: int = 200) -> int:
    """Partitions for a bulk sink: about ``each`` rows, within bounds."""
    return max(least, min(most, rows // each))


def file_partitions(rows: int, row_bytes: float, executor_bytes: int, least_bytes: int = 64 << 20) -> int:
    """Output partitions of at most a quarter of an executor's memory."""
    return max(1, round(rows * row_bytes / max(least_bytes, executor_bytes // 4)))


def write_bulk(df: DataFrame, key: str, value: str, put: Callable[[list[tuple[str, object]]], None], batch: int = 1000, retries: int = 3, wait: float = 1.0, prefix: str = "", upper: bool = False) -> None:
    """Hands (key, value) batches of each partition to ``put`` on the executors.

    A failing batch is tried again after wait x 2^n seconds; after the last try the task fails and
    Spark runs it again, so ``put`` must bear repeated batches.
    """

    def send(rows: list[tuple[str, object]]) -> None:
        for n in range(retries + 1):
            try:
                return put(rows)
            except OSError:
                if n == retries:
                    raise
                time.sleep(wait * 2**n)

    def partition(rows: Iterator) -> None:
        held = []
        for r in rows:
            k = f"{prefix}{r[key]}"
            held.append((k.upper() if upper else k, r[value]))
            if len(held) >= batch:
                send(held)
                held = []
        if held:
            send(held)

    df.select(key, value).foreachPartition(partition)


def already_done(last: date | None, day: date) -> bool:
    """A date is skipped if it isn't after the last one processed."""
    return last is not None and day <= last
