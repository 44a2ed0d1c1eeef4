"""Long to wide and back."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def pivot_first(df: DataFrame, index: Sequence[str], column: str, value: str, order: Sequence[str], values: Sequence | None = None) -> DataFrame:
    """One row for each index, one column for each of ``values``: the first value there in the given order.

    Rows with a missing index, column or value don't count.  With ``values``
    no job looks for them, and the schema is known.
    """
    rows = df.dropna(subset=[*index, column, value])
    grouped = rows.groupBy(*index).pivot(column, list(values)) if values is not None else rows.groupBy(*index).pivot(column)
    return grouped.agg(F.min_by(F.col(value), F.struct(*order)))


def count_matrix(df: DataFrame, row: Column, column: str, values: Sequence, weight: Column | None = None) -> DataFrame:
    """Counts (or sums) by row and column, 0 where there are none."""
    amount = F.count(F.lit(1)) if weight is None else F.sum(weight)
    return df.groupBy(row).pivot(column, list(values)).agg(amount).fillna(0)


def mean_matrix(df: DataFrame, row: Column, column: str, values: Sequence, value: Column) -> DataFrame:
    return df.groupBy(row).pivot(column, list(values)).agg(F.avg(value))


def unpivot(df: DataFrame, index: Sequence[str], values: Sequence[str], name: str = "key", value: str = "value") -> DataFrame:
    return df.unpivot(list(index), list(values), name, value)


def explode_results(df: DataFrame, results: str, analyses: Sequence[str] = (), listed: str = "analyses") -> DataFrame:
    """One row for each nested result, one for rows without any; 0/1 columns for the analyses that were made."""
    flags = {f"has_{a}": F.coalesce(F.array_contains(listed, a).cast("int"), F.lit(0)) for a in analyses}
    return df.withColumns(flags).withColumn("_r", F.explode_outer(results)).select("*", "_r.*").drop("_r", results)


def nest(df: DataFrame, keys: Sequence[str], head: Sequence[str], result: Sequence[str], order: Sequence[str], out: str = "results") -> DataFrame:
    """Rows of one sample to its head fields (of the first row in order) and a sorted array of result structs.

    An array is as long as a sample's rows, tens of analytes.
    """
    first = F.min_by(F.struct(*head), F.struct(*order)).alias("_head")
    return df.groupBy(*keys).agg(first, F.array_sort(F.collect_list(F.struct(*result))).alias(out)).select(*keys, "_head.*", out)


def split_rows(df: DataFrame, column: str, sep: str, out: str) -> DataFrame:
    """One row for each part of a separated text, none for rows without one."""
    return df.withColumn(out, F.explode(F.split(column, f"\\Q{sep}\\E"))).drop(column)
