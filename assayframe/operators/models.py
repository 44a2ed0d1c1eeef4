"""Tests and regressions from grouped sums; p-values by ``functions.distributions``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from assayframe.functions.distributions import p_of_range
from assayframe.functions.numbers import first_digit


def t_test(df: DataFrame, group: str, first, second, value: str, equal_variance: bool = True) -> DataFrame:
    """One row: sizes, means, t and degrees of freedom of two groups (pooled, or Welch's)."""
    stats = lambda g, i: (F.count(F.when(F.col(group) == g, F.col(value))).alias(f"n{i}"), F.avg(F.when(F.col(group) == g, F.col(value))).alias(f"mean{i}"), F.var_samp(F.when(F.col(group) == g, F.col(value))).alias(f"_v{i}"))
    row = df.where(F.col(group).isin(first, second)).agg(*stats(first, 1), *stats(second, 2))
    n1, n2, v1, v2 = (F.col(c) for c in ("n1", "n2", "_v1", "_v2"))
    if equal_variance:
        pooled = ((n1 - 1) * v1 + (n2 - 1) * v2) / (n1 + n2 - 2)
        error, freedom = F.sqrt(pooled * (1 / n1 + 1 / n2)), (n1 + n2 - 2).cast("double")
    else:
        a, b = v1 / n1, v2 / n2
        error, freedom = F.sqrt(a + b), (a + b) * (a + b) / (a * a / (n1 - 1) + b * b / (n2 - 1))
    return row.select("n1", "n2", "mean1", "mean2", F.try_divide(F.col("mean1") - F.col("mean2"), error).alias("t"), freedom.alias("freedom"))


def benford(df: DataFrame, value: str, groups: Sequence[str] = ()) -> DataFrame:
    """Counts of the first digits 1 to 9 and their expected counts by Benford's law, for each group."""
    digits = df.where(F.col(value) >= 1).groupBy(*groups, first_digit(F.col(value)).alias("digit")).agg(F.count("*").alias("n"))
    whole = F.sum("n").over(Window.partitionBy(*groups) if groups else Window.partitionBy(F.lit(0)))
    return digits.withColumn("expected", whole * F.log10(1 + 1 / F.col("digit")))


def chi_square(counts: DataFrame, groups: Sequence[str] = ()) -> DataFrame:
    """Sum of (n - expected)^2 / expected for each group."""
    return counts.groupBy(*groups).agg(F.sum(F.pow(F.col("n") - F.col("expected"), 2.0) / F.col("expected")).alias("chi_square"))


def trend(df: DataFrame, groups: Sequence[str], period, value: str) -> DataFrame:
    """Slope and intercept of a group's period means against their number (0, 1, ...)."""
    means = df.groupBy(*groups, period.alias("_period")).agg(F.avg(value).alias("_mean"))
    number = F.row_number().over(Window.partitionBy(*groups).orderBy("_period")) - 1
    return means.withColumn("_x", number.cast("double")).groupBy(*groups).agg(F.regr_slope("_mean", "_x").alias("slope"), F.regr_intercept("_mean", "_x").alias("intercept"), F.count("*").alias("periods"))


def origin_slope(df: DataFrame, groups: Sequence[str], x: str, y: str) -> DataFrame:
    """Slope of the least-squares line through the origin."""
    return df.groupBy(*groups).agg(F.try_divide(F.sum(F.col(x) * F.col(y)), F.sum(F.col(x) * F.col(x))).alias("slope"))


def anova(df: DataFrame, group: str, value: str) -> DataFrame:
    """One row: F statistic and degrees of freedom of a one-way analysis of variance."""
    cells = df.where(F.col(value).isNotNull()).groupBy(group).agg(F.count("*").alias("n"), F.avg(value).alias("m"), F.coalesce(F.var_samp(value), F.lit(0.0)).alias("v"))
    row = cells.agg(F.count("*").alias("k"), F.sum("n").alias("n"), F.sum(F.col("n") * F.col("m")).alias("s"), F.sum(F.col("n") * F.col("m") * F.col("m")).alias("ss"), F.sum((F.col("n") - 1) * F.col("v")).alias("within"))
    between = (F.col("ss") - F.col("s") * F.col("s") / F.col("n")) / (F.col("k") - 1)
    return row.select(F.try_divide(between, F.col("within") / (F.col("n") - F.col("k"))).alias("f"), (F.col("k") - 1).alias("between_freedom"), (F.col("n") - F.col("k")).alias("within_freedom"))


def pairwise_differences(df: DataFrame, group: str, value: str, levels: Sequence) -> DataFrame:
    """Difference of means, its standard error and the studentized range q of each pair of the given levels."""
    cells = df.where(F.col(group).isin(*levels)).groupBy(group).agg(F.count(value).alias("n"), F.avg(value).alias("m"), F.coalesce(F.var_samp(value), F.lit(0.0)).alias("v"))
    whole = Window.partitionBy(F.lit(0))  # as many rows as levels
    cells = cells.withColumn("_error", F.sum((F.col("n") - 1) * F.col("v")).over(whole) / (F.sum("n").over(whole) - F.count("*").over(whole)))
    a = cells.select(F.col(group).alias("a"), F.col("n").alias("na"), F.col("m").alias("ma"), "_error")
    b = F.broadcast(cells.select(F.col(group).alias("b"), F.col("n").alias("nb"), F.col("m").alias("mb")))
    pairs = a.join(b, F.col("a") < F.col("b"))
    error = F.sqrt(F.col("_error") / 2 * (1 / F.col("na") + 1 / F.col("nb")))
    return pairs.select("a", "b", (F.col("mb") - F.col("ma")).alias("difference"), error.alias("error"), F.try_divide(F.abs(F.col("mb") - F.col("ma")), error).alias("q"))


def tukey(df: DataFrame, group: str, value: str, levels: Sequence) -> DataFrame:
    """``pairwise_differences`` with the honest p-value of each pair among all of the levels that occur."""
    cells = df.where(F.col(group).isin(*levels) & F.col(value).isNotNull()).groupBy(group).count().agg(F.count("*").alias("_k"), (F.sum("count") - F.count("*")).alias("_freedom"))
    pairs = pairwise_differences(df, group, value, levels).join(F.broadcast(cells))  # one row
    return pairs.withColumn("p", p_of_range(F.col("q"), F.col("_k"), F.col("_freedom"))).drop("_k", "_freedom")


def categorical_regression(df: DataFrame, formula: str):
    """Least squares with categorical effects by a formula such as ``value ~ month + lab``; the fitted pipeline."""
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import RFormula
    from pyspark.ml.regression import LinearRegression

    return Pipeline(stages=[RFormula(formula=formula, handleInvalid="skip"), LinearRegression(solver="normal")]).fit(df)
