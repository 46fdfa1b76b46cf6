"""Registered queries by name, and the DuckDB SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.plans.views import SQL

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def _plain_times(df: DataFrame) -> DataFrame:
    """Timestamps without a zone, as the tables have them."""
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c, t in df.dtypes if t == "timestamp"})


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = wraps(f)(lambda spark, d: _plain_times(f(spark, d)))
        if sql is not None:
            ORACLES[f.__name__] = SQL.rstrip() + "\n" + sql if "v_" in sql else sql
        return f

    return add
