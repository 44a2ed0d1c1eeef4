"""Helpers shared by the corpus operators: tables kept between steps, Arrow text access."""

from __future__ import annotations

import tempfile
import uuid
import weakref
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Arrow text is worked on in slices of about this many bytes, so that a batch
#: of long documents needs no more memory than one of short documents.
SLICE_BYTES = 1 << 19
#: Bytes of an Arrow batch that goes to a Python worker: ten thousand rows, Spark's own limit, may be a gigabyte of long texts.
BATCH_BYTES = 4 << 20
#: Rows up to which a narrow table of keys is broadcast (some 16 bytes each); longer ones are joined by a shuffle.
BROADCAST_ROWS = 1_000_000


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors see: ``spark.checkpoint.dir``.

    In local mode a temporary folder takes its place where that is unset; on a
    cluster such a folder would be out of sight, so that is an error.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        master = spark.conf.get("spark.master", "")
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        path = "file://" + tempfile.mkdtemp(prefix="assayframe-")
        spark.conf.set("spark.checkpoint.dir", path)
    return path.rstrip("/")


def _folder(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/assayframe-{spark.sparkContext.applicationId}"


def _delete(spark: SparkSession, path: str) -> None:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def written(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Write df as a Parquet table in the shared folder and read it back: cuts lineage, survives lost executors."""
    path = f"{_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.options(**options).parquet(path)
    _log.append(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    _paths[id(out)] = path
    weakref.finalize(out, _paths.pop, id(out), None)
    return out


_paths: dict[int, str] = {}
#: All tables that were written, in order.
_log: list[str] = []


@contextmanager
def tidied(spark: SparkSession) -> Iterator[list[DataFrame]]:
    """Delete the tables that are written inside, but for those that are put into the list."""
    begin, keep = len(_log), []
    yield keep
    left = {path for df in keep for path in [_paths.get(id(df))] if path}
    for path in _log[begin:]:
        if path not in left:
            _delete(spark, path)
    _log[begin:] = [x for x in _log[begin:] if x in left]



def unwritten(table: DataFrame) -> None:
    """Delete a table that ``written`` returned and that no later step reads."""
    path = _paths.get(id(table))
    if path:
        _delete(table.sparkSession, path)


def discard(spark: SparkSession) -> None:
    """Delete all tables that this application has written between steps: results that were not read yet are lost."""
    _delete(spark, _folder(spark))


def private(df: DataFrame, *names: str) -> list[str]:
    """Column names that df doesn't have, whatever the case: the given ones with underscores in front."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        name = f"_{name}"
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def looked_up(rows: DataFrame, key: str, table: DataFrame) -> DataFrame:
    """Left join of rows to a table with one row for each key.

    The table is broadcast if its counted rows are few.  Beyond that, the keys
    that stand in more than a ``BROADCAST_ROWS``-th of all rows are: there can
    be no more than ``BROADCAST_ROWS`` of them.  The rest is shuffled, and no
    key of it is hot.  Both sides should be cheap to read twice (written ones).
    """
    if table.count() <= BROADCAST_ROWS:
        return rows.join(F.broadcast(table), key, "left")
    least = rows.count() // BROADCAST_ROWS
    (hot,) = private(rows, "hot")
    keys = F.broadcast(rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("_n")).where(F.col("_n") > least).select(key, F.lit(True).alias(hot)))
    marked = rows.join(keys, key, "left")
    few = F.broadcast(table.join(keys, key, "left_semi"))
    lone = F.col(key).isNull() | F.col(hot)
    return marked.where(lone).drop(hot).join(few, key, "left").unionByName(marked.where(~F.coalesce(lone, F.lit(False))).drop(hot).join(table, key, "left"))


def map_batches(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema) -> DataFrame:
    """mapInArrow over batches of bounded bytes; the session keeps the bound."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return df.mapInArrow(run, schema)


def text_slices(column: pa.Array, most: int = SLICE_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Yield (first row, offsets, bytes) of a string column without copying; null is empty.

    offsets has one entry more than the slice has rows and starts at 0.  A
    slice ends before it passes ``most`` bytes, but holds one row at least.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not pa.types.is_large_string(column.type):
        column = column.cast(pa.large_string())
    rows = len(column)
    if not rows:
        return
    buffers = column.buffers()
    offsets = np.frombuffer(buffers[1], np.int64, column.offset + rows + 1)[column.offset :]
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None and buffers[2].size else np.zeros(0, np.uint8)
    start = 0
    while start < rows:
        end = int(np.searchsorted(offsets, offsets[start] + most, side="right")) - 1
        end = min(rows, max(end, start + 1))
        yield start, offsets[start : end + 1] - offsets[start], data[offsets[start] : offsets[end]]
        start = end


def record_batch(schema: pa.Schema, *columns: np.ndarray | pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, type=f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)
