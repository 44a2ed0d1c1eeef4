"""De-duplication in an explicit order; missing keys equal missing keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key in the given order, which must be total for a repeatable result.

    The row is found by an aggregate over whole rows (``min_by``): partial
    results are merged before the shuffle, so a hot key costs a row a task.
    """
    best = F.min_by(F.struct(*df.columns), F.struct(*order))
    return df.groupBy(*[F.col(k).alias(f"_key_{k}") for k in keys]).agg(best.alias("_best")).select("_best.*")


def keep_latest(df: DataFrame, keys: Sequence[str], time: str, ties: Sequence[str] = ()) -> DataFrame:
    """The row with the latest time of each key, rows without a time last; then the smallest ties.

    Times that are numbers, dates or timestamps are turned around, so that
    partial results are merged before the shuffle; texts are put in order.
    """
    kind = dict(df.dtypes)[time]
    if kind == "string":
        newest = Window.partitionBy(*keys).orderBy(F.col(time).desc_nulls_last(), *[F.col(t).asc() for t in ties])
        return df.withColumn("_n", F.row_number().over(newest)).where("_n = 1").drop("_n")
    back = -F.unix_micros(F.col(time).cast("timestamp")) if kind.startswith(("timestamp", "date")) else -F.col(time)
    return keep_first(df, keys, [F.col(time).isNull(), back, *[F.col(t) for t in ties]])


def latest_values(log: DataFrame, key: str, value: str, order: Sequence[str]) -> DataFrame:
    """Last value of each key of an append-only log."""
    return log.groupBy(key).agg(F.max_by(value, F.struct(*order)).alias(value))


def successive(df: DataFrame, first: Sequence[str], second: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Keep the first by one key, and of those the first by another."""
    return keep_first(keep_first(df, first, order), second, order)


def duplicate_files(files: DataFrame, keep_oldest: bool = True) -> DataFrame:
    """Files (path, modificationTime, length, content) that repeat another's content in their folder, but for the kept one.

    Sizes are grouped first, from the listing alone: only files that share
    theirs with another of the folder are read and hashed.
    """
    age = F.col("modificationTime").asc() if keep_oldest else F.col("modificationTime").desc()
    folder = F.regexp_replace("path", "/[^/]*$", "").alias("folder")
    listed = files.select("path", "length", folder)
    alike = listed.join(listed.groupBy("folder", "length").count().where("count > 1"), ["folder", "length"]).select("path")
    hashed = files.join(alike, "path", "left_semi").select("path", "modificationTime", folder, F.sha2("content", 256).alias("hash"))
    order = Window.partitionBy("folder", "hash").orderBy(age, "path")
    return hashed.withColumn("_n", F.row_number().over(order)).where("_n > 1").drop("_n")


def duplicate_report(df: DataFrame, key: str, hashed: str) -> DataFrame:
    """One row: rows, distinct keys, rows without a key, rows in groups of several; and groups with several hashes.

    Rows without a key form one group.
    """
    groups = df.groupBy(key).agg(F.count("*").alias("n"), F.countDistinct(hashed).alias("hashes"))
    many = F.col("n") > 1
    return groups.agg(
        F.sum("n").alias("total"),
        F.count(key).alias("distinct_keys"),
        F.coalesce(F.sum(F.when(F.col(key).isNull(), F.col("n"))), F.lit(0)).alias("missing"),
        F.coalesce(F.sum(F.when(many, F.col("n"))), F.lit(0)).alias("in_duplicates"),
        F.coalesce(F.sum((many & (F.col("hashes") > 1)).cast("long")), F.lit(0)).alias("groups_with_several_hashes"),
    )
