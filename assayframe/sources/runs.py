"""Tables that grow by runs: a run's rows lie in a folder of their own and count from its mark on.

A run writes its rows to a new folder, then a mark, an empty file that names
folder and number.  Readers take the folders that have a mark, so a run that
ends early leaves the table as it was; its folder is never read.  Two runs that
end with the same number have read the same state: both are told and neither
counts.  ``compact`` writes a whole table as one run, and readers begin with the
last of these.  What earlier runs left can be deleted by ``clear`` when no
reader is at work.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_MARK = re.compile(r"^(\d{9})-(run|whole)-([0-9a-f]{32})$")


@dataclass(frozen=True, order=True)
class Run:
    number: int
    kind: str
    name: str


def _place(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def _names(spark: SparkSession, path: str) -> list[str]:
    files, place = _place(spark, path)
    return [x.getPath().getName() for x in files.listStatus(place)] if files.exists(place) else []


def marked(spark: SparkSession, path: str) -> list[Run]:
    """The runs that count, in order; of two with one number neither does."""
    found = [Run(int(m[1]), m[2], m[3]) for m in map(_MARK.match, _names(spark, f"{path}/_marks")) if m]
    alone = sorted(x for x in found if sum(y.number == x.number for y in found) == 1)
    begin = max((i for i, x in enumerate(alone) if x.kind == "whole"), default=0)
    return alone[begin:]


def _folder(path: str, run: Run) -> str:
    return f"{path}/run={run.name}"


def read_runs(spark: SparkSession, path: str, keys: Sequence[str] | None = None) -> DataFrame | None:
    """The rows of all runs that count, with keys the last run's row of each; None if there is no run."""
    own = marked(spark, path)
    if not own:
        return None
    parts = [spark.read.parquet(_folder(path, run)) for run in own]
    if keys and len(own) > 1:
        parts = [df.withColumn("_run", F.lit(run.number)) for df, run in zip(parts, own, strict=True)]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part, allowMissingColumns=True)
    if not keys or len(own) == 1:
        return out
    columns = [c for c in out.columns if c != "_run"]
    last = F.max_by(F.struct(*columns), F.col("_run")).alias("_last")
    return out.groupBy(*[F.col(k).alias(f"_key_{k}") for k in keys]).agg(last).select("_last.*")


def read_parts(spark: SparkSession, path: str, part: str, note: str) -> DataFrame | None:
    """The rows of all runs that count, of each value of ``part`` those of the last run whose note names it.

    A run takes the place of the values that it names as a whole, also where it
    has no rows for them.  Notes are one line for each run and value.
    """
    own = marked(spark, path)
    if not own:
        return None
    named: dict[str, Run] = {}
    for run in own:
        for value in spark.read.schema("value string").text(f"{path}/_notes/{note}-{run.name}").collect():
            named[value["value"]] = run
    out = None
    for run in own:
        live = [value for value, last in named.items() if last == run]
        rows = spark.read.parquet(_folder(path, run)).where(F.col(part).cast("string").isin(*live) if live else F.lit(False))
        out = rows if out is None else out.unionByName(rows, allowMissingColumns=True)
    return out


def store(df: DataFrame, path: str, partition: str | None = None) -> str:
    """Write rows to a folder that doesn't count yet; returns its name."""
    name = uuid.uuid4().hex
    (df.write.partitionBy(partition) if partition else df.write).parquet(f"{path}/run={name}")
    return name


def mark(spark: SparkSession, path: str, name: str, number: int, kind: str = "run") -> None:
    """Let a folder count as the run of a number; an error if another run has taken it."""
    files, place = _place(spark, f"{path}/_marks/{number:09d}-{kind}-{name}")
    files.create(place, False).close()
    if sum(x.startswith(f"{number:09d}-") for x in _names(spark, f"{path}/_marks")) > 1:
        files.delete(place, False)
        raise ValueError(f"another run has changed {path} meanwhile: run again")


def next_number(spark: SparkSession, path: str) -> int:
    return max((int(m[1]) for m in map(_MARK.match, _names(spark, f"{path}/_marks")) if m), default=0) + 1


def add_run(df: DataFrame, path: str, partition: str | None = None, kind: str = "run", note: tuple[str, Sequence[str]] | None = None) -> DataFrame:
    """Add rows as a run, with a note of some lines; returns them as they were written."""
    spark = df.sparkSession
    number = next_number(spark, path)
    name = store(df, path, partition)
    if note is not None:
        spark.createDataFrame([(x,) for x in note[1]], "value string").coalesce(1).write.text(f"{path}/_notes/{note[0]}-{name}")
    mark(spark, path, name, number, kind)
    return spark.read.schema(df.schema).parquet(f"{path}/run={name}")


def compact(spark: SparkSession, path: str, keys: Sequence[str] | None = None, partition: str | None = None) -> None:
    """Write what the table holds as one run."""
    whole = read_runs(spark, path, keys)
    if whole is not None:
        add_run(whole, path, partition, "whole")


def clear(spark: SparkSession, path: str) -> int:
    """Delete folders that don't count, and marks of runs before the last whole one; returns how many folders."""
    live = {x.name for x in marked(spark, path)}
    gone = [x[4:] for x in _names(spark, path) if x.startswith("run=") and x[4:] not in live]
    for name in [x for x in _names(spark, f"{path}/_marks") if x[-32:] not in live]:
        files, place = _place(spark, f"{path}/_marks/{name}")
        files.delete(place, False)
    for name in gone:
        files, place = _place(spark, f"{path}/run={name}")
        files.delete(place, True)
    return len(gone)
