"""Incremental runs: only what is new is read, de-duplicated, published or counted again."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from assayframe.sources.sinks import changed_only, upsert_documents


def new_files(spark: SparkSession, folder: str, schema, pattern: str = "*.parquet", kind: str = "parquet") -> DataFrame:
    """A stream of the files that come into a folder; its checkpoint remembers those that were read."""
    return spark.readStream.schema(schema).option("pathGlobFilter", pattern).format(kind).load(folder)


def first_seen(stream: DataFrame, keys: Sequence[str], time: str | None = None, late: str = "1 day") -> DataFrame:
    """The first row of each key; with a time column keys are forgotten after the watermark."""
    if time is None:
        return stream.dropDuplicates(list(keys))
    return stream.withWatermark(time, late).dropDuplicatesWithinWatermark(list(keys))


def period_counts(stream: DataFrame, time: str, width: str, groups: Sequence[str | Column] = (), value: str | None = None, late: str = "1 day", slide: str | None = None) -> DataFrame:
    """Counts (and sums) of each window and group, closed after the watermark."""
    window = F.window(time, width, slide) if slide else F.window(time, width)
    amounts = [F.count("*").alias("n"), *([F.sum(value).alias("total")] if value else [])]
    out = stream.withWatermark(time, late).groupBy(window, *groups).agg(*amounts)
    return out.select(F.col("window.start").alias("start"), F.col("window.end").alias("end"), *[c for c in out.columns if c != "window"])


def run_available(df: DataFrame, checkpoint: str, path: str | None = None, each: Callable[[DataFrame, int], None] | None = None, mode: str = "append") -> StreamingQuery:
    """Work through what is there, then end: to Parquet files, or batch by batch to a function."""
    writer = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True)
    query = writer.foreachBatch(each).start() if each is not None else writer.format("parquet").option("path", path).start()
    query.awaitTermination()
    return query


def publish_unseen(path: str, ledger: str, key: str) -> Callable[[DataFrame, int], None]:
    """A batch function that publishes the documents whose key isn't in the ledger; a repeated batch adds nothing."""

    def each(batch: DataFrame, _: int) -> None:
        upsert_documents(batch.dropDuplicates([key]), path, ledger, key)

    return each


def publish_changes(read: Callable[[], DataFrame], statistics: Callable[[DataFrame], DataFrame], path: str, keys: Sequence[str]) -> Callable[[DataFrame, int], None]:
    """A batch function that makes the statistics again and appends the rows that changed."""

    def each(batch: DataFrame, number: int) -> None:
        from assayframe.operators.dedupe import keep_latest
        from assayframe.sources.sinks import _existing

        old = _existing(batch.sparkSession, path)
        before = keep_latest(old, keys, "_batch").drop("_batch") if old is not None else None
        changed_only(statistics(read()), before, keys).withColumn("_batch", F.lit(number)).write.mode("append").parquet(path)

    return each
