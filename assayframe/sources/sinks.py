"""Sinks: dated copies, partitioned upserts, document upserts with a ledger, changes only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from assayframe.operators.dedupe import keep_first

from . import runs


def save_dated(df: DataFrame, folder: str, prefix: str, date: str, latest: bool = True, kind: str = "csv") -> list[str]:
    """Write ``prefix-date`` and ``prefix-latest`` folders; returns their paths."""
    paths = [f"{folder}/{prefix}-{date}", *([f"{folder}/{prefix}-latest"] if latest else [])]
    for path in paths:
        df.write.mode("overwrite").option("header", True).format(kind).save(path)
    return paths


def save_formats(df: DataFrame, path: str, kinds: Sequence[str] = ("parquet", "csv", "json")) -> list[str]:
    """The same rows in several formats, one folder each."""
    out = []
    for kind in kinds:
        df.write.mode("overwrite").option("header", True).format(kind).save(f"{path}.{kind}")
        out.append(f"{path}.{kind}")
    return out


def _existing(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.parquet(path)
    except Exception as problem:
        if "PATH_NOT_FOUND" in str(problem) or "UNABLE_TO_INFER_SCHEMA" in str(problem):
            return None
        raise


def upsert_partitions(new: DataFrame, path: str, keys: Sequence[str], partition: str, order: Sequence[str]) -> None:
    """Add rows to the partitions they belong to; of equal keys the stored row stays, of new ones the first by order.

    Only the partitions that new rows belong to are read, and only rows that
    are not stored yet are written, as a run of the table (see ``runs``).
    """
    first = keep_first(new, keys, [F.col(c) for c in order])
    old = runs.read_runs(new.sparkSession, path)
    if old is not None:
        touched = new.select(partition).distinct()
        stored = old.join(F.broadcast(touched) if touched.count() <= 10_000 else touched, partition, "left_semi")
        first = _unstored(first, stored, keys)
    runs.add_run(first, path, partition)


def _unstored(rows: DataFrame, stored: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose keys are not among the stored ones; a missing key equals a missing key."""
    known = stored.select(*[F.col(k).alias(f"_done_{k}") for k in keys]).distinct()
    return rows.join(known, [F.col(k).eqNullSafe(F.col(f"_done_{k}")) for k in keys], "left_anti")


def upsert_documents(new: DataFrame, path: str, ledger: str, key: str = "id", update: bool = False, order: Sequence[Column] = ()) -> DataFrame:
    """Add documents whose key is in neither the table nor the ledger, and their keys to the ledger; returns what was added.

    Of several new rows with a key the last by order is taken (without an order,
    the last by all columns).  With ``update`` all new documents are added, and
    take the place of stored ones with their key.  A run is complete with its
    mark (see ``runs``): where one ends before, the table is as it was, and the
    same call makes it good.  Where it ends between the mark and the ledger,
    keys of stored documents count as done all the same.
    """
    spark = new.sparkSession
    turned = F.struct(*order) if order else F.struct(*new.columns)
    last = new.groupBy(F.col(key).alias("_key")).agg(F.max_by(F.struct(*new.columns), turned).alias("_last")).select("_last.*")
    done, old = _existing(spark, ledger), runs.read_runs(spark, path, [key])
    unseen = last
    for known in (x for x in (done, old) if x is not None):
        unseen = _unstored(unseen, known, [key])
    added = runs.add_run(last if update else unseen, path)
    fresh = added.select(key).distinct()
    (fresh if done is None else _unstored(fresh, done, [key])).write.mode("append").parquet(ledger)
    return added


def read_documents(spark: SparkSession, path: str, key: str = "id") -> DataFrame | None:
    """The stored documents, the last one of each key."""
    return runs.read_runs(spark, path, [key])


def content_hash(columns: Sequence[str]) -> Column:
    """Hash of a row's columns as JSON, without those that only tell when it was made."""
    return F.sha2(F.to_json(F.struct(*sorted(columns)), {"ignoreNullFields": "false"}), 256)


def changed_only(now: DataFrame, before: DataFrame | None, keys: Sequence[str], ignore: Sequence[str] = ("updated_at",)) -> DataFrame:
    """Rows that are new or differ from the stored ones with their keys, ignoring some columns."""
    columns = [c for c in now.columns if c not in ignore]
    hashed = now.withColumn("_hash", content_hash(columns))
    if before is None:
        return hashed.drop("_hash")
    stored = before.select(*[F.col(k).alias(f"_old_{k}") for k in keys], content_hash(columns).alias("_stored"))
    same = [F.col(k).eqNullSafe(F.col(f"_old_{k}")) for k in keys]
    return hashed.join(stored, same, "left").where(~F.col("_hash").eqNullSafe(F.col("_stored"))).select(*now.columns)


def append_ledger(df: DataFrame, path: str, key: str) -> None:
    """Append rows as JSON lines ``{key, value}``."""
    df.select(F.col(key).cast("string").alias("key"), F.struct(*[c for c in df.columns if c != key]).alias("value")).write.mode("append").json(path)


def unregistered(files: DataFrame, registry: DataFrame) -> DataFrame:
    """Files (path, content) whose content hash isn't registered, with the hash; equal new ones once."""
    hashed = files.select("path", F.sha2("content", 256).alias("hash"))
    fresh = hashed.join(registry.select("hash").distinct(), "hash", "left_anti")
    return keep_first(fresh, ["hash"], [F.col("path")])


def working_dir(spark: SparkSession, name: str) -> str:
    """A new folder's path below ``spark.checkpoint.dir``, which all executors share; a local one only where that is unset."""
    import tempfile
    import uuid

    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.conf.get("spark.master", "")
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="assayframe-")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def kept(df: DataFrame, name: str) -> DataFrame:
    """df written in the working folder and read back: what several steps read is made once."""
    path = working_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
