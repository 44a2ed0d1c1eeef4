"""Frequencies, shares, retention, change, rates, periods and market matrices.

All functions take the group's columns as a list, give rows (not maps), and
break ties by value, so that results are the same for any partitioning.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from assayframe.functions.dates import PERIODS, period_start
from assayframe.functions.numbers import round_even


def value_counts(df: DataFrame, groups: Sequence[str], column: str) -> DataFrame:
    """Rows for each group and value that is there."""
    return df.where(F.col(column).isNotNull()).groupBy(*groups, column).agg(F.count("*").alias("n"))


def top_counts(df: DataFrame, groups: Sequence[str], column: str, n: int) -> DataFrame:
    """The n most frequent values of each group, with their rank."""
    order = Window.partitionBy(*groups).orderBy(F.desc("n"), F.asc(column))
    return value_counts(df, groups, column).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)


def concentration(df: DataFrame, groups: Sequence[str], column: str, n: int = 10) -> DataFrame:
    """Percent of a group's rows (missing values too) that its n most frequent values have."""
    top = top_counts(df, groups, column, n).groupBy(*groups).agg(F.sum("n").alias("top"))
    total = df.groupBy(*groups).agg(F.count("*").alias("total"))
    return total.join(top, list(groups), "left").withColumn("percent", round_even(F.coalesce("top", F.lit(0)) * 100.0 / F.col("total"), 2))


def distribution(df: DataFrame, groups: Sequence[str], column: str) -> DataFrame:
    """Percent of a group's rows for each value; missing values count in the whole, but have no row."""
    counts = df.groupBy(*groups, column).agg(F.count("*").alias("n"))
    whole = F.sum("n").over(Window.partitionBy(*groups))
    return counts.withColumn("percent", round_even(F.col("n") * 100.0 / whole, 2)).where(F.col(column).isNotNull())


def per_entity(df: DataFrame, groups: Sequence[str], entity: str) -> DataFrame:
    """Rows for each distinct entity of a group."""
    return df.groupBy(*groups).agg(F.count("*").alias("n"), F.countDistinct(entity).alias("entities")).withColumn("average", F.try_divide(F.col("n").cast("double"), F.col("entities")))


def latest_year_months(df: DataFrame, groups: Sequence[str], date: str) -> DataFrame:
    """Rows for each month of a group's latest year."""
    monthly = df.groupBy(*groups, F.year(date).alias("year"), F.month(date).alias("month")).agg(F.count("*").alias("n"))
    latest = F.max("year").over(Window.partitionBy(*groups))
    return monthly.withColumn("_latest", latest).where("year = _latest").drop("_latest")


def retention(df: DataFrame, groups: Sequence[str], entity: str, year: str) -> DataFrame:
    """Entities of a year that were there in the year before, for all listed years but the first."""
    seen = df.where(F.col(entity).isNotNull()).select(*groups, entity, year).distinct()
    before = seen.select(*groups, entity, (F.col(year) + 1).alias(year), F.lit(1).alias("_stayed"))
    years = df.select(*groups, year).distinct().withColumn("_first", F.min(year).over(Window.partitionBy(*groups))).where(f"{year} > _first").drop("_first")
    kept = seen.join(before, [*groups, entity, year]).groupBy(*groups, year).agg(F.count("*").alias("retained"))
    return years.join(kept, [*groups, year], "left").fillna(0, ["retained"])


def new_and_returning(df: DataFrame, groups: Sequence[str], entity: str, year: str) -> DataFrame:
    """Entities of each year: all, those of the year listed before, and others."""
    seen = df.where(F.col(entity).isNotNull()).select(*groups, entity, year).distinct()
    listed = seen.select(*groups, year).distinct().withColumn("_next", F.lead(year).over(Window.partitionBy(*groups).orderBy(year)))
    before = seen.join(listed.where("_next IS NOT NULL"), [*groups, year]).select(*groups, entity, F.col("_next").alias(year), F.lit(1).alias("_stayed"))
    marked = seen.join(before, [*groups, entity, year], "left")
    return marked.groupBy(*groups, year).agg(F.count("*").alias("total"), F.count("_stayed").alias("returning")).withColumn("new", F.col("total") - F.col("returning"))


def adoption(df: DataFrame, groups: Sequence[str], entity: str, year: str) -> DataFrame:
    return df.groupBy(*groups, year).agg(F.countDistinct(entity).alias("entities"))


def change(now: Column, before: Column) -> Column:
    """Percent of change, NULL without a value before or from 0."""
    return round_even(F.try_divide((now - before) * 100.0, before), 2)


def market_share(df: DataFrame, entity: str, market: str, known_only: bool = False) -> DataFrame:
    """Percent of a market's rows for each entity; with ``known_only`` the whole leaves out rows without an entity."""
    counts = df.groupBy(market, entity).agg(F.count("*").alias("n"))
    part = F.when(F.col(entity).isNotNull(), F.col("n")) if known_only else F.col("n")
    whole = F.sum(part).over(Window.partitionBy(market))
    return counts.withColumn("percent", round_even(F.try_divide(F.col("n") * 100.0, whole), 2)).where(F.col(entity).isNotNull())


def nested_distinct(df: DataFrame, groups: Sequence[str], second: str, entity: str) -> DataFrame:
    return df.groupBy(*groups, second).agg(F.countDistinct(entity).alias("entities"))


def quarters(df: DataFrame, groups: Sequence[str], date: str, entities: Sequence[str]) -> DataFrame:
    """Rows and distinct entities for all four quarters of each listed year, 0 where there is nothing."""
    years = df.select(*groups, F.year(date).alias("year")).distinct()
    grid = years.withColumn("quarter", F.explode(F.sequence(F.lit(1), F.lit(4))))
    counts = df.groupBy(*groups, F.year(date).alias("year"), F.quarter(date).alias("quarter")).agg(F.count("*").alias("n"), *[F.countDistinct(e).alias(f"n_{e}") for e in entities])
    return grid.join(counts, [*groups, "year", "quarter"], "left").fillna(0)


def totals(df: DataFrame, distinct: Sequence[str]) -> DataFrame:
    """One row: rows, and distinct values of columns."""
    return df.agg(F.count("*").alias("n"), *[F.countDistinct(c).alias(f"n_{c}") for c in distinct])


#: Names of the periods in results.
PERIOD_NAMES = {"day": "daily", "week": "weekly", "month": "monthly", "quarter": "quarterly", "year": "yearly"}


def describe_periods(df: DataFrame, date: str, values: Mapping[str, Sequence[str]], kinds: Sequence[str] = PERIODS, exact: bool = True) -> DataFrame:
    """Count, mean, deviation, quartiles and maximum of compounds for each day, week, month, quarter and year.

    values are the columns of each type of compound.  Equal values of a day
    are counted first, so that the longer periods work on counts, not on rows.
    ``exact`` percentiles keep a count of each value of a group; approximate
    ones have bounded memory and take all rows.
    """
    every = [c for columns in values.values() for c in columns]
    long = df.select(F.col(date).cast("date").alias("_day"), *[F.col(c).cast("double").alias(c) for c in every]).unpivot(["_day"], every, "compound", "value").where("value IS NOT NULL")
    types = F.create_map(*[F.lit(x) for kind, columns in values.items() for c in columns for x in (c, kind)])
    spans = F.explode(F.array(*[F.struct(F.lit(PERIOD_NAMES.get(k, k)).alias("period"), period_start(k, F.col("_day")).alias("start")) for k in kinds])).alias("_p")
    keys = ["period", "start", "type", "compound"]
    shares = F.array(*[F.lit(q) for q in (0.25, 0.5, 0.75)])
    counts = long.groupBy("_day", "compound", "value").agg(F.count("*").alias("_n"))
    rows = counts.select(types[F.col("compound")].alias("type"), "compound", "value", "_n", spans).select("type", "compound", "value", "_n", "_p.*")
    if not exact:
        rows = long.select(types[F.col("compound")].alias("type"), "compound", "value", F.lit(1).alias("_n"), spans).select("type", "compound", "value", "_n", "_p.*")
    n, total, squares = F.sum("_n"), F.sum(F.col("value") * F.col("_n")), F.sum(F.col("value") * F.col("value") * F.col("_n"))
    quartiles = F.percentile("value", shares, F.col("_n")) if exact else F.percentile_approx("value", [0.25, 0.5, 0.75])
    out = rows.groupBy(*keys).agg(n.alias("n"), (total / n).alias("mean"), F.sqrt(F.try_divide(F.greatest(squares - total * total / n, F.lit(0.0)), n - 1)).alias("std"), quartiles.alias("_q"), F.max("value").alias("max"))
    return out.select(*keys, "n", "mean", "std", *[F.col("_q")[i].alias(name) for i, name in enumerate(("q25", "q50", "q75"))], "max")


def quantiles(df: DataFrame, groups: Sequence[str], column: str, shares: Sequence[float] = (0.01, 0.25, 0.5, 0.75, 0.99)) -> DataFrame:
    """Exact quantiles with mean, median, largest, smallest and (smallest) most frequent value; all from counts of values."""
    counts = df.where(F.col(column).isNotNull()).groupBy(*groups, column).agg(F.count("*").alias("_n"))
    listed = F.percentile(column, F.array(*[F.lit(q) for q in (*shares, 0.5)]), F.col("_n")).alias("_q")
    mean = (F.sum(F.col(column) * F.col("_n")) / F.sum("_n")).alias("mean")
    out = counts.groupBy(*groups).agg(listed, mean, F.max(column).alias("max"), F.min(column).alias("min"), F.max_by(column, F.struct("_n", -F.col(column))).alias("mode"))
    return out.select(*groups, *[F.col("_q")[i].alias(f"q{round(q * 100):02d}") for i, q in enumerate(shares)], "mean", F.col("_q")[len(shares)].alias("median"), "max", "min", "mode")


def rate(df: DataFrame, groups: Sequence[Column | str], flag: Column, tested_only: bool = False) -> DataFrame:
    """Percent of rows with a flag; rows without one count as not flagged, or (``tested_only``) not at all."""
    value = flag.cast("int") if tested_only else F.coalesce(flag, F.lit(False)).cast("int")
    return df.groupBy(*groups).agg(F.count("*").alias("n"), (F.avg(value) * 100).alias("rate"))


def above(column: str, limit: float, inclusive: bool = True) -> Column:
    return F.col(column) >= limit if inclusive else F.col(column) > limit


def all_and_any(df: DataFrame, keys: Sequence[str], flag: Column) -> DataFrame:
    """Whether all or any flags of a key hold, and Pass or Fail for the first."""
    out = df.groupBy(*keys).agg(F.bool_and(flag).alias("all_passed"), F.bool_or(flag).alias("any_passed"))
    return out.withColumn("status", F.when(F.col("all_passed"), "Pass").otherwise("Fail"))


def joined_notes(df: DataFrame, keys: Sequence[str], note: str, order: Sequence[str], out: str = "notes") -> DataFrame:
    """Distinct notes of each key in the order they are first seen, joined by ``, ``."""
    first = df.where(F.col(note).isNotNull()).groupBy(*keys, note).agg(F.min(F.struct(*order)).alias("_seen"))
    listed = F.array_sort(F.collect_list(F.struct("_seen", note)))
    return first.groupBy(*keys).agg(F.array_join(F.transform(listed, lambda x: x[note]), ", ").alias(out))


def histogram(df: DataFrame, column: str, bins: int, low: float, high: float) -> DataFrame:
    """Counts and density of equal bins; the highest value falls in the last bin, values outside are left out."""
    width = (high - low) / bins
    inside = df.where(F.col(column).between(low, high))
    place = F.least(F.floor((F.col(column) - low) / width), F.lit(bins - 1)).cast("int")
    counts = inside.groupBy(place.alias("bin")).agg(F.count("*").alias("n"))
    whole = F.sum("n").over(Window.partitionBy(F.lit(0)))
    return counts.withColumn("density", F.col("n") / (whole * F.lit(width)))


def lump_rare(df: DataFrame, column: str, least: int, other: str = "Other") -> DataFrame:
    """Counts of values, those below a number of rows together."""
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n"))
    name = F.when(F.col("n") < least, other).otherwise(F.col(column))
    return counts.groupBy(name.alias(column)).agg(F.sum("n").alias("n"))


def market_matrix(df: DataFrame, period: str, entity: str, top: int = 10, other: str = "Others") -> DataFrame:
    """Share of each period's rows for the entities with the largest sums of shares, and the rest of the whole.

    Periods and top entities form a full grid.
    """
    counts = df.where(F.col(entity).isNotNull()).groupBy(period, entity).agg(F.count("*").alias("n"))
    shares = counts.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy(period)))
    ranked = shares.groupBy(entity).agg(F.round(F.sum("share"), 9).alias("_all")).orderBy(F.desc("_all"), entity).limit(top).select(entity)
    names = F.broadcast(ranked.agg(F.collect_list(entity).alias("_names")))  # at most ``top`` names
    grid = shares.select(period).distinct().join(names, F.lit(True)).select(period, F.explode("_names").alias(entity))
    held = grid.join(shares, [period, entity], "left").select(period, entity, F.coalesce("share", F.lit(0.0)).alias("share"))
    rest = held.groupBy(period).agg((1 - F.sum("share")).alias("share")).select(period, F.lit(other).alias(entity), "share")
    return held.unionByName(rest)


def per_capita(df: DataFrame, period: Column, year: Column, population: dict[int, float], per: float = 100_000.0) -> DataFrame:
    """Rows a period for each ``per`` heads of the year's population; NULL for years without one."""
    heads = F.try_element_at(F.create_map(*[x for k, v in population.items() for x in (F.lit(k), F.lit(float(v)))]), F.col("year"))
    return df.groupBy(period.alias("period"), year.alias("year")).agg(F.count("*").alias("n")).withColumn("per_capita", F.try_divide(F.col("n").cast("double"), heads / per))


def monthly_cost(df: DataFrame, date: str, unit_cost: float, ahead: int = 3) -> DataFrame:
    """One row: cost of all rows, and with as many months more at the monthly mean."""
    monthly = df.groupBy(period_start("month", F.col(date)).alias("m")).agg(F.count("*").alias("n"))
    return monthly.agg((F.sum("n") * unit_cost).alias("cost"), (F.sum("n") * unit_cost + ahead * F.avg("n") * unit_cost).alias("projected"))


def before_after(df: DataFrame, date: str, event: str, value: str) -> DataFrame:
    """Mean before an event's date, and from it on."""
    early = F.col(date) < F.lit(event).cast("timestamp_ntz")
    return df.groupBy(early.alias("before")).agg(F.count(value).alias("n"), F.avg(value).alias("mean"))


def moving_average(df: DataFrame, value: str, order: Sequence[str], rows: int = 30, *, groups: Sequence[str]) -> DataFrame:
    """Mean of a row's value and those before it in its group, by rows.  Each group is one ordered series."""
    frame = Window.partitionBy(*groups).orderBy(*order).rowsBetween(1 - rows, 0)
    return df.withColumn("moving_average", F.avg(value).over(frame))


def trimmed(df: DataFrame, groups: Sequence[str], order: str, first: int = 2, last: int = 1) -> DataFrame:
    """Each group's rows in order, without some at either end."""
    up, whole = Window.partitionBy(*groups).orderBy(order), Window.partitionBy(*groups)
    return df.withColumns({"_i": F.row_number().over(up), "_n": F.count("*").over(whole)}).where(f"_i > {first} AND _i <= _n - {last}").drop("_i", "_n")


def aggregated(df: DataFrame, groups: Sequence[str], amounts: Mapping[str, tuple[str, str]]) -> DataFrame:
    """Several aggregates of one key in one pass: name to (count, distinct, sum, mean, min, max or std; column)."""
    kinds = {"count": F.count, "distinct": F.countDistinct, "sum": F.sum, "mean": F.avg, "min": F.min, "max": F.max, "std": F.stddev_samp}
    return df.groupBy(*groups).agg(*[kinds[kind](column).alias(name) for name, (kind, column) in amounts.items()])


def accuracy(df: DataFrame, right: Column, name: str = "right") -> DataFrame:
    """One row: rows, those for which a condition holds, and their share."""
    hits = F.count_if(F.coalesce(right, F.lit(False)))
    return df.agg(F.count("*").alias("n"), hits.alias(name), F.try_divide(hits.cast("double"), F.count("*")).alias("accuracy"))


def with_flags(df: DataFrame, keys: Sequence[str], any_of: Mapping[str, Column], all_of: Mapping[str, Column]) -> DataFrame:
    """Each row with the flags of its whole key: whether any, or all, of its rows have it.

    The flags are summed up before they meet the rows, so that no key's rows
    have to be in one task.
    """
    flags = df.groupBy(*keys).agg(*[F.bool_or(c).alias(n) for n, c in any_of.items()], *[F.bool_and(c).alias(n) for n, c in all_of.items()])
    return df.join(flags, list(keys), "left")


def segments(df: DataFrame, date: str, spans: Sequence[tuple[str, str]], out: str = "segment") -> DataFrame:
    """Rows within given spans of days (both ends included), with the number of their span; others are left out."""
    day = F.col(date).cast("timestamp")
    found = F.coalesce(*[F.when(day.between(F.lit(a).cast("timestamp"), F.lit(z).cast("timestamp")), F.lit(i)) for i, (a, z) in enumerate(spans)])
    return df.withColumn(out, found).where(F.col(out).isNotNull())
