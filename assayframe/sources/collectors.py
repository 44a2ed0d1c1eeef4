"""Collectors as a source: what each makes of an item is read by Spark, and what fails becomes a row.

A collector has a name, the schema of its records, fields that a record must
have, a list of items, and a function that makes records of one item.  Items
are partitions of a Python data source, so they are collected by Spark's tasks;
as a stream only new items are, and Spark's checkpoint remembers which.  Items
that lie in a table already (pages, raw documents) are collected from it.

All collectors have one outcome table (source, item, record, error, at): a record
as JSON, or the error of an item.  An item that raises an error, or a record
that lacks a field, doesn't touch the others: its failure is noted while the
source runs.  ``records`` reads a collector's records in its schema, ``failures``
the rest.

Defined cases: an item without records leaves no row; a collector whose list of
items fails is one failure without an item; values that don't fit the schema
are NULL; repeated items are collected as often as they are listed; null items
of a table are left out.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable, Iterator, Mapping, Sequence
from dataclasses import dataclass, field
from datetime import datetime, timezone

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

OUTCOME = "source string, item string, record string, error string, at timestamp"
_NAMES = ["source", "item", "record", "error", "at"]


@dataclass(frozen=True)
class Collector:
    """What is collected: ``collect(item)`` makes records; ``items()`` lists what there is, in an order in which new items come last."""

    name: str
    schema: str
    collect: Callable[[str], Iterable[Mapping]]
    items: Callable[[], Sequence[str]] = field(default=lambda: ())
    required: Sequence[str] = ()


def outcome(collector: Collector, item: str, given: str | None = None) -> list[tuple]:
    """The outcome rows of one item; ``given`` is its content where a table has it."""
    now = datetime.now(timezone.utc)
    try:
        found = []
        for record in collector.collect(item if given is None else given):
            missing = [x for x in collector.required if record.get(x) in (None, "")]
            if missing:
                found.append((collector.name, item, None, f"missing: {', '.join(missing)}", now))
            else:
                found.append((collector.name, item, json.dumps(dict(record), default=str), None, now))
        return found
    except Exception as problem:  # whatever a collector raises is its item's failure
        return [(collector.name, item, None, f"{type(problem).__name__}: {problem}", now)]


@dataclass
class _Lot(InputPartition):
    collector: str
    items: list[str]
    error: str | None = None


def _lots(collectors: Mapping[str, Collector], size: int, after: Mapping[str, int] | None = None, until: Mapping[str, int] | None = None) -> list[_Lot]:
    out = []
    for name, c in collectors.items():
        try:
            items = list(c.items())[(after or {}).get(name, 0) : None if until is None else until.get(name, 0)]
        except Exception as problem:
            out.append(_Lot(name, [], f"{type(problem).__name__}: {problem}"))
            continue
        out += [_Lot(name, items[i : i + size]) for i in range(0, len(items), size)]
    return out


def _read(collectors: Mapping[str, Collector], lot: _Lot) -> Iterator[tuple]:
    if lot.error is not None:
        yield (lot.collector, None, None, lot.error, datetime.now(timezone.utc))
    for item in lot.items:
        yield from outcome(collectors[lot.collector], item)


def source_of(collectors: Sequence[Collector], name: str = "collectors", size: int = 50) -> type[DataSource]:
    """A data source for ``spark.dataSource.register``: each partition is up to ``size`` items of one collector."""
    by_name = {c.name: c for c in collectors}
    if len(by_name) < len(collectors):
        raise ValueError("collectors need names of their own")

    class Reader(DataSourceReader):
        def partitions(self) -> list[_Lot]:
            return _lots(by_name, size) or [_Lot(collectors[0].name, [])]

        def read(self, partition: _Lot) -> Iterator[tuple]:
            return _read(by_name, partition)

    class Stream(DataSourceStreamReader):
        def initialOffset(self) -> dict:
            return dict.fromkeys(by_name, 0)

        def latestOffset(self) -> dict:
            out = {}
            for key, c in by_name.items():
                try:
                    out[key] = len(c.items())
                except Exception:  # nothing new is known of it; a batch read tells why
                    out[key] = 0
            return out

        def partitions(self, start: dict, end: dict) -> list[_Lot]:
            return _lots(by_name, size, start, end)

        def read(self, partition: _Lot) -> Iterator[tuple]:
            return _read(by_name, partition)

    class Source(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def schema(self) -> str:
            return OUTCOME

        def reader(self, schema) -> Reader:
            return Reader()

        def streamReader(self, schema) -> Stream:
            return Stream()

    return Source


def collected(spark: SparkSession, collectors: Sequence[Collector], size: int = 50) -> DataFrame:
    """The outcomes of all items of some collectors."""
    spark.dataSource.register(source_of(collectors, size=size))
    return spark.read.format("collectors").load()


def collected_stream(spark: SparkSession, collectors: Sequence[Collector], size: int = 50) -> DataFrame:
    """The outcomes of new items, as a stream."""
    spark.dataSource.register(source_of(collectors, size=size))
    return spark.readStream.format("collectors").load()


def collected_from(items: DataFrame, collectors: Sequence[Collector], item: str, content: str) -> DataFrame:
    """The outcomes of the items of a table: each row's content goes to every collector."""
    narrow = items.select(F.col(item).cast("string").alias("item"), F.col(content).alias("content")).where("item IS NOT NULL")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = (pa.string(), pa.string(), pa.string(), pa.string(), pa.timestamp("us", "UTC"))
        for batch in batches:
            for key, given in zip(*(batch.column(i).to_pylist() for i in (0, 1)), strict=True):
                rows = [x for c in collectors for x in outcome(c, key, given or "")]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows, strict=True), kinds, strict=True)], _NAMES)

    return narrow.mapInArrow(run, OUTCOME)


def records(outcomes: DataFrame, collector: Collector) -> DataFrame:
    """A collector's records in its schema, with ``source`` and ``item``."""
    fields = T.StructType.fromDDL(collector.schema).fields
    nested = lambda f: isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType))
    # plain values are read as text first: a number may be told as one
    read = T.StructType([T.StructField(f.name, f.dataType if nested(f) else T.StringType()) for f in fields])
    own = outcomes.where((F.col("source") == collector.name) & F.col("record").isNotNull()).select("source", "item", F.from_json("record", read).alias("r"))
    return own.select("source", "item", *[F.col("r")[f.name].alias(f.name) if nested(f) else F.col("r")[f.name].try_cast(f.dataType).alias(f.name) for f in fields])


def all_records(outcomes: DataFrame, collectors: Sequence[Collector]) -> DataFrame:
    """The records of all collectors, by name; fields that a collector doesn't have are NULL."""
    out = records(outcomes, collectors[0])
    for c in collectors[1:]:
        out = out.unionByName(records(outcomes, c), allowMissingColumns=True)
    return out


def failures(outcomes: DataFrame) -> DataFrame:
    """(source, item, error, at) of what could not be collected."""
    return outcomes.where(F.col("error").isNotNull()).select("source", "item", "error", "at")
