"""Registry of named queries over the driver tables, each with an optional
DuckDB-runnable SQL statement computing the same result (the oracle)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(key: str, sql: str | None = None):
    def deco(fn):
        if key in QUERIES:
            raise ValueError(f"duplicate query key {key}")
        QUERIES[key] = fn
        if sql is not None:
            ORACLE[key] = sql
        return fn
    return deco


def normalize(df: DataFrame) -> DataFrame:
    """Output types the oracle compares on: integers as BIGINT, timestamps
    without zone, floats as DOUBLE."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            c = c.cast("bigint")
        elif isinstance(f.dataType, T.TimestampType):
            c = c.cast("timestamp_ntz")
        elif isinstance(f.dataType, T.FloatType):
            c = c.cast("double")
        cols.append(c.alias(f.name))
    return df.select(*cols)
