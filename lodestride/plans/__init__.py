"""Registered queries: name -> plan over the tables of one folder, and its SQL twin."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None, dates: tuple[str, ...] = ()) -> Callable[[Query], Query]:
    """Adds a query under ``name``; ``oracle`` is the same result as DuckDB SQL.

    Columns in ``dates`` are compared as text, for the two engines hand out dates of different kinds.
    """

    def put(query: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        if oracle is not None:
            replaced = ", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in dates)
            ORACLES[name] = f"SELECT * REPLACE ({replaced}) FROM ({oracle})" if dates else oracle
        QUERIES[name] = wraps(query)(lambda spark, sf_dir: query(spark, sf_dir).withColumns({c: F.col(c).cast("string") for c in dates})) if dates else query
        return query

    return put
