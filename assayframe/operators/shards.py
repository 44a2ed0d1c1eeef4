"""Enrichment of a table from a set of shard files, with both sides bucketed once by their key.

Shards are read one by one: renamed, cut to the columns that are wanted, and
written together into one table that is bucketed and sorted by the key.  The
other side is bucketed alike.  Joins and groupings on the key then take place
bucket by bucket, and no exchange stands above the scans, however often the two
meet.  Of several values for a key the first shard that has one wins, column by
column (later shards fill what is still missing); within a shard the first row
by its order.

Rows without a key meet nothing and are kept apart from the buckets.  A key that
very many rows of the left side have fills one bucket; ``joins.lookup``, whose
join Spark can split, suits such tables.

Defined cases: columns that a shard lacks are NULL there; without shards all
columns are NULL; rows repeated on the left side stay repeated; columns of the
left side with the names of added ones are replaced.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BUCKETS = 200


@dataclass(frozen=True)
class Shard:
    """A shard's rows, and how its columns are named in the result."""

    table: DataFrame
    rename: Mapping[str, str] = field(default_factory=dict)


@dataclass(frozen=True)
class Bucketed:
    """A table of the catalogue that is bucketed by a key, and the rows without a key."""

    name: str
    key: str
    loose: DataFrame | None = None

    def read(self, spark: SparkSession) -> DataFrame:
        return spark.table(self.name)

    def drop(self, spark: SparkSession) -> None:
        spark.sql(f"DROP TABLE IF EXISTS {self.name}")


def bucketed(df: DataFrame, key: str, buckets: int = BUCKETS) -> Bucketed:
    """Write a table bucketed and sorted by a key."""
    name = f"bucketed_{uuid.uuid4().hex}"
    # rows are dealt by bucket first: one file a bucket, not one for each task and bucket
    df.where(F.col(key).isNotNull()).repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key).format("parquet").saveAsTable(name)
    return Bucketed(name, key, df.where(F.col(key).isNull()))


def stacked(shards: Sequence[Shard], key: str, columns: Mapping[str, str], order: Mapping[str, str], buckets: int = BUCKETS) -> Bucketed:
    """All shards as one bucketed table: the key, columns and order (names to types), and the shard's number, ``_shard``."""
    out = None
    for i, shard in enumerate(shards):
        own = shard.table.withColumnsRenamed(dict(shard.rename))
        values = {c: (F.col(c) if c in own.columns else F.lit(None)).cast(kind) for c, kind in {**columns, **order}.items()}
        part = own.select(F.col(key), *[v.alias(c) for c, v in values.items()], F.lit(i).alias("_shard"))
        out = part if out is None else out.unionByName(part)
    if out is None:
        raise ValueError("no shards")
    return bucketed(out, key, buckets)


def first_values(shards: Bucketed, columns: Sequence[str], order: Sequence[str], spark: SparkSession) -> DataFrame:
    """One row for each key: of each column the first value that is there, by shard, then by the order."""
    place = F.struct("_shard", *order)
    pick = [F.min_by(F.when(F.col(c).isNotNull(), F.col(c)), F.when(F.col(c).isNotNull(), place)).alias(c) for c in columns]
    return shards.read(spark).groupBy(shards.key).agg(*pick)


def enriched(left: Bucketed, shards: Bucketed, columns: Sequence[str], order: Sequence[str], spark: SparkSession) -> DataFrame:
    """The left side with the first values of its key, NULL where no shard has one."""
    own = left.read(spark)
    base = own.drop(*columns)
    out = base.join(first_values(shards, columns, order, spark), left.key, "left")
    kinds = dict(out.dtypes)
    if left.loose is None:
        return out
    return out.unionByName(left.loose.drop(*columns).withColumns({c: F.lit(None).cast(kinds[c]) for c in columns}))


def matched(left: Bucketed, shards: Bucketed, columns: Sequence[str], order: Sequence[str], spark: SparkSession) -> DataFrame:
    """The rows of the left side that a shard has, once for each shard that has them, with that shard's first row and number."""
    first = F.min_by(F.struct(*columns), F.struct(*order)).alias("_row")
    # a shard is dealt with its key: the bucket's own grouping
    own = shards.read(spark).groupBy(shards.key, "_shard").agg(first).select(shards.key, "_shard", "_row.*")
    return left.read(spark).drop(*columns).join(own, left.key)
