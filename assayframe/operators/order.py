"""Places, ranks and moving means in one order of a whole table, without a task that holds it all.

Rows are dealt into ranges of the order and written once with the number of
their range, so that a range keeps its rows.  Ranges are ordered by themselves;
their sizes, one line each, are summed up on the driver, and a row's place is
what lies before its range plus its place in it.  A moving frame needs the last
rows of the ranges before: these border rows are copied to the ranges that look
back at them.

Orders should end with a key that tells rows apart: rows that are equal in the
whole order share a range, whatever their number, and their places among each
other are arbitrary.  ``ranked`` numbers equal rows alike, so it takes orders
with ties; a tie of so many rows that they fill a range is one task's work.

Defined cases: nulls come first in ascending, last in descending order (as the
given columns say); an empty table stays empty; columns with the names of the
added ones are replaced.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from assayframe.sources.sinks import kept

_RANGE = "_range"


def ranges(df: DataFrame, order: Sequence[Column], parts: int | None = None) -> DataFrame:
    """df dealt into ranges of an order and written, with the number of the range in ``_range``."""
    placed = df.repartitionByRange(parts, *order) if parts else df.repartitionByRange(*order)
    return kept(placed.withColumn(_RANGE, F.spark_partition_id()), "ranges")


def _before(sizes: dict[int, int]) -> list[int]:
    """Rows before each range, by its number."""
    return list(accumulate([0, *(sizes.get(n, 0) for n in range(max(sizes, default=0)))]))


def _of_range(values: list[int]) -> Column:
    """The value of a row's range, of an array with one entry for each range."""
    return F.get(F.array(*[F.lit(v).cast("long") for v in values]), F.col(_RANGE))


def numbered(df: DataFrame, order: Sequence[Column], out: str = "place", parts: int | None = None) -> DataFrame:
    """df with the place of each row in an order, from 1."""
    dealt = ranges(df.drop(out), order, parts)
    return _numbered(dealt, order, out).drop(_RANGE)


def _sizes(dealt: DataFrame) -> dict[int, int]:
    return {r[0]: r[1] for r in dealt.groupBy(_RANGE).count().collect()}  # one line for each range


def _numbered(dealt: DataFrame, order: Sequence[Column], out: str) -> DataFrame:
    inside = F.row_number().over(Window.partitionBy(_RANGE).orderBy(*order))
    return dealt.withColumn(out, _of_range(_before(_sizes(dealt))) + inside)


def ranked(df: DataFrame, order: Sequence[Column], keys: Sequence[str], rank: str = "rank", dense: str = "dense_rank", parts: int | None = None) -> DataFrame:
    """df with rank and dense rank in an order; ``keys`` are the columns of the order: equal rows have equal ranks."""
    dealt = ranges(df.drop(rank, dense), order, parts)
    counted = dealt.groupBy(_RANGE).agg(F.count("*").alias("n"), F.count_distinct(F.struct(*keys)).alias("d")).collect()  # one line for each range
    inside = Window.partitionBy(_RANGE).orderBy(*order)
    rows, values = (_before({r[_RANGE]: r[name] for r in counted}) for name in ("n", "d"))
    return dealt.withColumns({rank: _of_range(rows) + F.rank().over(inside), dense: _of_range(values) + F.dense_rank().over(inside)}).drop(_RANGE)


def moving(df: DataFrame, value: str, order: Sequence[Column], rows: int = 30, out: str = "moving_average", parts: int | None = None) -> DataFrame:
    """df with the mean of each row's value and those of the ``rows - 1`` before it in the whole order; missing values don't count."""
    dealt = ranges(df.drop(out), order, parts)
    numbers, starts = _numbered(dealt, order, "_place"), _before(_sizes(dealt))
    # a row is looked back at by the ranges that start less than a frame behind it: the last rows of a range only
    firsts = F.array(*[F.struct(F.lit(i).alias("to"), F.lit(v + 1).cast("long").alias("first")) for i, v in enumerate(starts)])
    last = numbers.where(_of_range([*starts[1:], 1 << 62]) < F.col("_place") + (rows - 1))
    near = F.filter(firsts, lambda x: (x["first"] > F.col("_place")) & (x["first"] < F.col("_place") + rows))
    borders = last.withColumn("_to", F.explode(near)).select(*[c for c in numbers.columns if c != _RANGE], F.col("_to.to").alias(_RANGE), F.lit(True).alias("_border"))
    both = numbers.withColumn("_border", F.lit(False)).unionByName(borders)
    frame = Window.partitionBy(_RANGE).orderBy("_place").rowsBetween(1 - rows, 0)
    return both.withColumn(out, F.avg(value).over(frame)).where(~F.col("_border")).drop(_RANGE, "_place", "_border")
