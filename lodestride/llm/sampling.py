"""The bounded sample of documents that a classifier is fitted on."""

from __future__ import annotations

import zlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def held_out(doc_id: Column) -> Column:
    """Rows that no classifier learns from: crc32 of the id as text, modulo 3, is 1."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def crc(value: str) -> int:
    return zlib.crc32(value.encode())


def bounded(rows: DataFrame, limit: int, *tie: str) -> DataFrame:
    """At most ``limit`` rows, the same ones for the same table, spread evenly by hash."""
    return rows.orderBy(F.xxhash64(F.lit(7), *tie), *tie).limit(limit)
