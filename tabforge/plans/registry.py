"""Registry of named queries: a Spark builder and, where SQL can express it, the DuckDB oracle."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def round_doubles(df: DataFrame, places: int = 6) -> DataFrame:
    """Round every double column so that results computed in a different order compare equal."""
    return df.select(*[
        F.round(F.col(f"`{f.name}`"), places).alias(f.name) if isinstance(f.dataType, (T.DoubleType, T.FloatType))
        else F.col(f"`{f.name}`") for f in df.schema.fields])


def register(name: str, sql: str | None = None, rounded: bool = True):
    def deco(fn: QueryFn) -> QueryFn:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            df = fn(spark, sf_dir)
            return round_doubles(df) if rounded else df
        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return run
    return deco
