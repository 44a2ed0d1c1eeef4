"""Dates: parsing without errors, period labels, month sequences."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FORMATS = ("yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd", "M/d/yyyy H:mm", "M/d/yyyy", "yyyy-M", "MMMM d, yyyy")
PERIODS = ("day", "week", "month", "quarter", "year")


def parsed(col: Column, formats: Sequence[str] = FORMATS) -> Column:
    """Timestamp by the first format that fits, NULL if none does."""
    return F.coalesce(*[F.try_to_timestamp(col, F.lit(f)) for f in formats])


def without_zone(col: Column) -> Column:
    return col.cast("timestamp_ntz")


def month_label(col: Column) -> Column:
    return F.date_format(col, "yyyy-MM")


def year_label(col: Column) -> Column:
    return F.date_format(col, "yyyy")


def week_label(col: Column) -> Column:
    """``Monday/Sunday`` of the date's week."""
    monday = F.date_trunc("week", col).cast("date")
    return F.concat(monday.cast("string"), F.lit("/"), F.date_add(monday, 6).cast("string"))


def year_month(year: Column, month: Column) -> Column:
    return F.concat(year.cast("string"), F.lit("-"), F.lpad(month.cast("string"), 2, "0"))


def period_start(kind: str, col: Column) -> Column:
    return F.date_trunc(kind, col).cast("date")


def period_end(kind: str, start: Column) -> Column:
    """Last day of the period that starts on a date; weeks end on Sunday."""
    if kind == "day":
        return start
    if kind == "week":
        return F.date_add(start, 6)
    return F.date_sub(F.add_months(start, {"month": 1, "quarter": 3, "year": 12}[kind]), 1)


def iso_text(col: Column) -> Column:
    """ISO text of a date text; text that can't be parsed stays as it is."""
    return F.coalesce(F.date_format(parsed(col), "yyyy-MM-dd'T'HH:mm:ss"), col)


def short_year(col: Column) -> Column:
    """``mm/dd/yy`` as ``20yy-mm-dd``; other texts stay."""
    return F.regexp_replace(col, r"^(\d{2})/(\d{2})/(\d{2})$", "20$3-$1-$2")


def date_parts(df: DataFrame, column: str) -> DataFrame:
    """Add date_tested week, month and year labels, NULL for rows without a valid date."""
    return df.withColumns({"week": week_label(F.col(column)), "month": month_label(F.col(column)), "year": year_label(F.col(column))})


def fill_months(df: DataFrame, month: str, value: str) -> DataFrame:
    """One row for every month from the first to the last; months that are not there get 0.

    The bounds are one row; the calendar is as long as the time they span.
    """
    bounds = df.agg(F.min(month).alias("a"), F.max(month).alias("z"))
    calendar = bounds.select(F.explode(F.sequence("a", "z", F.expr("interval 1 month"))).alias(month))
    return calendar.join(df, month, "left").withColumn(value, F.coalesce(F.col(value), F.lit(0)))
