"""A registry of queries over the test tables, each with SQL for the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession

from assayframe.functions.numbers import round_even

Tables = Callable[[str], DataFrame]

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a function of a table reader under its name."""

    def add(function: Callable[[Tables], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return function(lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet"))

        run.__name__ = function.__name__
        QUERIES[function.__name__] = run
        if sql is not None:
            ORACLES[function.__name__] = sql
        return function

    return add


def r6(col: Column) -> Column:
    """Six digits: sums of doubles differ in the last bits with their order."""
    return round_even(col, 6)


def s6(expression: str, digits: int = 6) -> str:
    """The same in SQL."""
    return f"round_even(({expression}) * 1e{digits}, 0) / 1e{digits}"
