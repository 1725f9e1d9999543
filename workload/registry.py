"""Name -> (Spark query, SQL that must give the same table)."""

from __future__ import annotations

import functools
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meridia.session import ship

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        @functools.wraps(fn)
        def shipped(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship(spark)
            return fn(spark, sf_dir)

        QUERIES[name] = shipped
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


# Doubles are compared at a fixed number of places. The cut is moved off .5, where averages of
# values with two decimals fall exactly and the last bit would decide.


def fixed(value: Column | str, places: int = 4) -> Column:
    value = F.col(value) if isinstance(value, str) else value
    scale = float(10**places)
    return F.floor(value * scale + 0.501).cast("double") / scale


def fixed_sql(expr: str, places: int = 4) -> str:
    scale = f"{10**places}.0::double"
    return f"(floor(({expr}) * {scale} + 0.501::double)::double / {scale})"


def fix(df: DataFrame, columns: Sequence[str], places: int = 4) -> DataFrame:
    return df.withColumns({c: fixed(c, places) for c in columns})


def fix_sql(columns: Sequence[str], places: int = 4) -> str:
    """``* REPLACE`` list for the same columns."""
    return "* REPLACE (" + ", ".join(f"{fixed_sql(c, places)} AS {c}" for c in columns) + ")"
