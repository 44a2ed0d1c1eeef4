"""Number helpers with explicit rules for missing values, division and rounding."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def number(col: Column) -> Column:
    """DOUBLE, or NULL where the text isn't a number; NaN counts as missing."""
    value = col.try_cast("double")
    return F.when(~F.isnan(value), value)


def round_even(col: Column, digits: int) -> Column:
    """Round half to even at ``digits`` places."""
    scale = F.lit(float(10**digits))
    return F.rint(col * scale) / scale


def safe_ratio(top: Column, bottom: Column) -> Column:
    """top / bottom as DOUBLE; NULL if either is missing, not a number, or the divisor is 0."""
    return F.try_divide(number(top), number(bottom))


def row_sum(cols: Sequence[Column], min_count: int = 0) -> Column:
    """Sum of the values that are there; NULL if fewer than ``min_count`` are."""
    total = sum((F.coalesce(c.cast("double"), F.lit(0.0)) for c in cols), F.lit(0.0))
    if min_count <= 0:
        return total
    there = sum((c.isNotNull().cast("int") for c in cols), F.lit(0))
    return F.when(there >= min_count, total)


def row_argmax(cols: dict[str, Column]) -> Column:
    """Name of the largest value, the first in order on ties; NULL if all are missing."""
    top = F.greatest(*cols.values()) if len(cols) > 1 else next(iter(cols.values()))
    return F.coalesce(*[F.when(c == top, F.lit(name)) for name, c in cols.items()])


def first_digit(col: Column) -> Column:
    """First character of the whole part: 0 for values below 1."""
    return F.substring(col.cast("long").cast("string"), 1, 1).cast("int")


def counting_method(col: Column) -> Column:
    """``plating`` for whole multiples of ten, else ``qPCR``; NULL if missing."""
    return F.when(col.isNotNull(), F.when(F.pmod(col, F.lit(10.0)) == 0, "plating").otherwise("qPCR"))
