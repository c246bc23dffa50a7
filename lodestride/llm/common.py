"""Helpers shared by the corpus operators."""

from __future__ import annotations

import ctypes
import gc
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def _shared_folder(spark: SparkSession) -> str:
    """The session's own folder below ``spark.checkpoint.dir``. Only a local master may do without that setting: it gets a temporary one."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder and not context.master.startswith("local[") and context.master != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        context.setCheckpointDir(folder or tempfile.mkdtemp(prefix="checkpoints-"))
    return context.getCheckpointDir()


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` computed once and kept in the shared folder; for narrow tables."""
    _shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read again; for tables with texts."""
    path = f"{_shared_folder(df.sparkSession)}/{uuid.uuid4().hex}.parquet"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def few(rows: DataFrame, n: int) -> DataFrame:
    """At most ``n`` rows, as a table of their own; Spark reads partitions, the first ones first, until it has them. They pass through the driver, so ``rows`` should be short."""
    return rows.sparkSession.createDataFrame(rows.limit(n).collect(), rows.schema)


def _return_memory() -> None:
    """What a task has freed goes back to the system: Python workers live on, and those of several stages share a machine."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc alone has it
    if trim is not None:
        trim(0)


def map_batches(df: DataFrame, function: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: T.StructType | str) -> DataFrame:
    """Applies ``function`` to each Arrow batch; rows stay where Spark put them."""
    return map_tasks(df, lambda: function, schema)


def map_tasks(df: DataFrame, begin: Callable[[], Callable[[pa.RecordBatch], pa.RecordBatch | None]], schema: T.StructType | str) -> DataFrame:
    """As map_batches, with a function of its own (and its caches) for each task; they go when the task ends."""

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        function = begin()
        try:
            for batch in batches:
                out = function(batch)
                if out is not None:
                    yield out
        finally:
            del function
            _return_memory()

    return df.mapInArrow(over, schema)


def strings(column: pa.Array) -> list[str]:
    """Python strings of a text column, null as the empty text."""
    return [x or "" for x in column.to_pylist()]
