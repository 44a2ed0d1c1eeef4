"""Statistics kept as states of a day that can be merged: longer periods, and days that change, without reading the rest again.

A state of a day and group holds the count, exact sums of values and squares (as
decimals), least and greatest value, a HyperLogLog sketch of distinct keys and a
KLL sketch of the values.  Weeks to years are merged from days.  Days are stored
by runs; a run holds the days that it was made for, and takes the place of these
as a whole, so a late correction is one run of one day.

Counts, sums, means, deviations, least and greatest are exact.  Distinct counts
are off by some 1.04 / sqrt(2**LG_K) of their size (1.6 %, two thirds of the
time), quantiles by some 1.3 % of the rank; both may change a little, within
that, with the order in which states are merged.

Defined cases: rows without a day are left out; missing values count in ``n`` only,
missing keys in no distinct count; a day without rows has no state (a run for it
removes it); values are taken to ``DIGITS`` decimals.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assayframe.functions.dates import period_start
from assayframe.sources import runs

LG_K, DIGITS = 12, 4
DAY = "day"


def day_states(df: DataFrame, time: str, groups: Sequence[str], value: str, key: str) -> DataFrame:
    """States of each day and group: of a value, and of the distinct values of a key."""
    v = F.col(value).cast("double")
    exact = F.col(value).cast(f"decimal({14 + DIGITS},{DIGITS})")
    return df.withColumn(DAY, F.to_date(time)).where(F.col(DAY).isNotNull()).groupBy(DAY, *groups).agg(
        F.count("*").alias("n"),
        F.count(v).alias("values"),
        F.sum(exact).cast(f"decimal(38,{DIGITS})").alias("total"),
        F.sum((exact * exact).cast(f"decimal(38,{2 * DIGITS})")).cast(f"decimal(38,{2 * DIGITS})").alias("squares"),
        F.min(v).alias("least"),
        F.max(v).alias("greatest"),
        F.hll_sketch_agg(F.col(key).cast("string"), LG_K).alias("keys"),
        F.kll_sketch_agg_double(v).alias("spread"),
    )


def merged(states: DataFrame, groups: Sequence[str], period: str = "month", quantiles: Sequence[float] = (0.25, 0.5, 0.75)) -> DataFrame:
    """Statistics of each period and group from day states: n, mean, std, least, greatest, distinct, quantiles."""
    joined = states.groupBy(period_start(period, F.col(DAY)).alias("period"), *groups).agg(
        F.sum("n").alias("n"), F.sum("values").alias("values"), F.sum("total").alias("total"), F.sum("squares").alias("squares"), F.min("least").alias("least"), F.max("greatest").alias("greatest"),
        F.hll_union_agg("keys").alias("keys"), F.kll_merge_agg_double("spread").alias("spread"),
    )
    n, total, squares = F.col("values").cast("double"), F.col("total").cast("double"), F.col("squares").cast("double")
    spread = F.when(n > 0, F.kll_sketch_get_quantile_double("spread", F.array(*[F.lit(float(q)) for q in quantiles])))
    return joined.select(
        "period", *groups, "n", F.try_divide(total, n).alias("mean"), F.when(n > 1, F.sqrt(F.greatest(F.lit(0.0), F.try_divide(squares - total * total / n, n - 1)))).alias("std"), "least", "greatest",
        F.hll_sketch_estimate("keys").alias("distinct"), spread.alias("quantiles"),
    )


def stored(spark: SparkSession, path: str) -> DataFrame | None:
    """The states that count: each day as the last run for it made it."""
    return runs.read_parts(spark, path, DAY, "days")


def update(source: DataFrame, path: str, days: Sequence[date], time: str, groups: Sequence[str], value: str, key: str) -> None:
    """Make the states of some days again and store them as a run.

    The source is filtered by these days: of files that are partitioned by
    ``time`` as a date, the others are not read.
    """
    asked = source.where(F.col(time).cast("date").isin(*days)) if dict(source.dtypes)[time] != "date" else source.where(F.col(time).isin(*days))
    made = day_states(asked, time, groups, value, key)
    runs.add_run(made, path, note=("days", [d.isoformat() for d in days]))
