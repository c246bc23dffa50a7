"""A folder that driver and executors share, for tables that a job writes on its way."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below ``spark.checkpoint.dir``. Only a local master may do without that setting: it gets a temporary folder."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        master = spark.sparkContext.master
        if not master.startswith("local[") and master != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="scratch-")
        spark.sparkContext.setCheckpointDir(folder)
    return f"{folder.rstrip('/')}/{name}_{uuid.uuid4().hex}"
