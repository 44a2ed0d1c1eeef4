"""Nearest vectors of a stated set of queries, by numpy over Arrow batches: exact, or by an index of coarse cells.

``nearest`` compares every query to every vector.  ``nearest_by_cells`` fits cell
centres on a bounded sample, assigns every vector to the cell of its nearest
centre, and compares a query to the vectors of the few cells nearest to it.
Vectors and queries of a cell are dealt into slices, each of which meets each
of the other kind, so a task holds about ``SLICE`` of either at once; their
similarities are computed in lots, of which only the k best of a query stay.
What it misses is measured by ``recall`` against ``nearest``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Queries that go around in one pass.
BLOCK = 4_000
#: Vectors that are compared at once, to as many queries at most.
LOT = 1_000
#: Vectors that cell centres are fitted on; vectors of one cell, and queries, that a task holds.
SAMPLE, SLICE = 20_000, 20_000
#: Numbers that the vectors of a slice have: of long vectors there are fewer in a slice.
HELD = SLICE * 64


def nearest(vectors: DataFrame, queries: DataFrame, key: str, vector: str, k: int, digits: int = 6, block: int = BLOCK) -> DataFrame:
    """(q, key, similarity, rank): the k vectors most similar to each query by cosine, ties by key, none with its own key.

    Queries go around in blocks of bounded size, one pass over the vectors for
    each; a task returns k rows for each query at most, and a window takes
    the best of these.  Vectors that are null, or whose length is
    0 or not finite, are similar to none; a query is compared to vectors with
    as many components only; rows without a key are left out.
    """
    out = f"q long, `{key}` long, similarity double"
    asked = queries.where(F.col(key).isNotNull() & (F.size(vector) > 0))
    counts = {r[0]: r[1] for r in asked.groupBy(F.size(vector)).count().collect()}  # one line for each number of components
    parts = []
    for size, n in sorted(counts.items()):
        own = vectors.where(F.col(key).isNotNull() & (F.size(vector) == size)).select(F.col(key).cast("long").alias(key), F.col(vector).cast("array<double>").alias(vector))
        count = -(-n // block)
        for at in range(count):
            rows = asked.where((F.size(vector) == size) & (F.pmod(F.xxhash64(key), F.lit(count)) == at)).select(key, F.col(vector).cast("array<double>")).collect()
            if rows:
                grid = np.array([[np.nan if x is None else x for x in r[1]] for r in rows], np.float64)
                shared = vectors.sparkSession.sparkContext.broadcast((np.array([r[0] for r in rows], np.int64), _unit(grid)))
                parts.append(own.mapInArrow(_best(shared, key, k, digits), out))
    if not parts:
        return vectors.sparkSession.createDataFrame([], f"{out}, rank int")
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    best = Window.partitionBy("q").orderBy(F.desc("similarity"), key)
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)


def _best(shared, key: str, k: int, digits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, grid = shared.value
        held = _NONE
        for batch in batches:
            for begin in range(0, batch.num_rows, LOT):
                part = batch.slice(begin, LOT)
                ids = part.column(0).to_numpy(zero_copy_only=False)
                own = _unit(part.column(1).flatten().to_numpy(zero_copy_only=False).reshape(len(ids), -1))
                held = _best_of([held, _searched(names, grid, ids, own, k, digits)], k)
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in held], ["q", key, "similarity"])

    return run


def centres(vectors: DataFrame, key: str, vector: str, cells: int, sample: int = SAMPLE, rounds: int = 10, seed: int = 0) -> np.ndarray:
    """Unit vectors of cell centres, fitted in one task on a sample of about ``sample`` vectors at most."""
    size = vectors.count()
    chance = F.pmod(F.xxhash64(F.lit(seed), key), F.lit(1 << 30)) / F.lit(float(1 << 30))
    some = vectors.where(chance < sample / max(1, size)).select(F.col(key).cast("long"), F.col(vector).cast("array<double>"))

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [(b.column(0).to_numpy(zero_copy_only=False), b.column(1).flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, -1)) for b in batches if b.num_rows]
        if not parts:
            return
        ids, rows = (np.concatenate(x) for x in zip(*parts, strict=True))
        rows = _unit(rows[np.argsort(ids, kind="stable")])
        rows = rows[np.isfinite(rows).all(axis=1)]
        middle = rows[np.random.default_rng(seed).permutation(len(rows))[:cells]]
        for _ in range(rounds if len(middle) else 0):
            place = (rows @ middle.T).argmax(axis=1)
            sums = np.zeros_like(middle)
            np.add.at(sums, place, rows)
            moved = np.nan_to_num(_unit(sums))
            middle = np.where((moved == 0).all(axis=1, keepdims=True), middle, moved)
        yield pa.RecordBatch.from_arrays([pa.array(range(len(middle)), pa.int32()), pa.array(middle.tolist(), pa.list_(pa.float64()))], ["cell", "centre"])

    found = some.repartition(1).mapInArrow(fit, "cell int, centre array<double>").orderBy("cell").collect()  # as many rows as cells
    return np.array([r["centre"] for r in found], np.float64)


def _in_cells(df: DataFrame, key: str, vector: str, middle: np.ndarray, probes: int) -> DataFrame:
    """(key, vector, cell): each vector with the ``probes`` cells whose centres are nearest to it."""
    shared = df.sparkSession.sparkContext.broadcast(middle)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, LOT):
                part = batch.slice(begin, LOT)
                rows = _unit(part.column(1).flatten().to_numpy(zero_copy_only=False).reshape(part.num_rows, -1))
                good = np.flatnonzero(np.isfinite(rows).all(axis=1))
                cell = np.argsort(-(rows[good] @ shared.value.T), axis=1, kind="stable")[:, :probes]
                took = part.take(pa.array(np.repeat(good, cell.shape[1])))
                yield pa.RecordBatch.from_arrays([took.column(0), took.column(1), pa.array(cell.reshape(-1), pa.int32())], ["key", "vector", "cell"])

    size = middle.shape[1]
    whole = df.where(F.col(key).isNotNull() & (F.size(vector) == size)).select(F.col(key).cast("long"), F.col(vector).cast("array<double>"))
    return whole.mapInArrow(run, "key long, vector array<double>, cell int")


def nearest_by_cells(vectors: DataFrame, queries: DataFrame, key: str, vector: str, k: int, cells: int = 64, probes: int = 12, digits: int = 6, sample: int = SAMPLE) -> DataFrame:
    """(q, key, similarity, rank) as of ``nearest``, from the ``probes`` cells nearest to each query.

    Vectors with another number of components than the sample's, that are null,
    or whose length is 0 or not finite, are in no cell.
    """
    middle = centres(vectors.where(F.size(vector) > 0), key, vector, cells, sample)
    out = f"q long, `{key}` long, similarity double"
    if not len(middle):
        return vectors.sparkSession.createDataFrame([], f"{out}, rank int")
    own, asked = _in_cells(vectors, key, vector, middle, 1), _in_cells(queries, key, vector, middle, probes)
    rows = min(SLICE, max(1, HELD // middle.shape[1]))
    slices = lambda df, name: df.groupBy("cell").agg(F.ceil(F.count("*") / F.lit(rows)).cast("long").alias(name))
    sizes = F.broadcast(slices(own, "n").join(slices(asked, "m"), "cell"))  # as many rows as cells
    own = own.join(sizes, "cell").withColumns({"slice": F.pmod(F.xxhash64("key"), "n"), "block": F.explode(F.sequence(F.lit(0).cast("long"), F.col("m") - 1))}).drop("n", "m")
    asked = asked.join(sizes, "cell").withColumns({"slice": F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)), "block": F.pmod(F.xxhash64("key"), "m")}).drop("n", "m")

    def meet(rows: pa.Table, of: pa.Table) -> pa.Table:
        found = _NONE
        if rows.num_rows and of.num_rows:
            ids, own = rows["key"].to_numpy(), _unit(_rows(rows["vector"]))
            found = _searched(of["key"].to_numpy(), _unit(_rows(of["vector"])), ids, own, k, digits)
        return pa.table([pa.array(x) for x in found], ["q", key, "similarity"])

    found = own.groupBy("cell", "slice", "block").cogroup(asked.groupBy("cell", "slice", "block")).applyInArrow(meet, out)
    best = Window.partitionBy("q").orderBy(F.desc("similarity"), key)
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)


def recall(found: DataFrame, exact: DataFrame, key: str) -> DataFrame:
    """One row: how many of the exact neighbours there are, how many were found, and the share."""
    both = exact.select("q", key).join(found.select("q", key, F.lit(1).alias("_hit")), ["q", key], "left")
    return both.agg(F.count("*").alias("exact"), F.count("_hit").alias("found"), F.try_divide(F.count("_hit").cast("double"), F.count("*")).alias("recall"))


def _rows(column: pa.ChunkedArray) -> np.ndarray:
    whole = column.combine_chunks()
    return whole.flatten().to_numpy(zero_copy_only=False).reshape(len(whole), -1)


#: No (query, key, similarity).
_NONE = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))


def _searched(names: np.ndarray, grid: np.ndarray, ids: np.ndarray, own: np.ndarray, k: int, digits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``_top`` of any number of queries and vectors, by lots of either."""
    parts = []
    for i in range(0, len(names), LOT):
        held = _NONE
        for j in range(0, len(ids), LOT):
            held = _best_of([held, _top(names[i : i + LOT], grid[i : i + LOT], ids[j : j + LOT], own[j : j + LOT], k, digits)], k)
        parts.append(held)
    return tuple(np.concatenate(x) for x in zip(*parts, strict=True)) if parts else _NONE


def _best_of(parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]], k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The k best of each query of several (query, key, similarity), ties by key."""
    q, at, value = (np.concatenate(x) for x in zip(*parts, strict=True))
    order = np.lexsort((at, -value, q))
    q, at, value = q[order], at[order], value[order]
    keep = np.arange(len(q)) - np.searchsorted(q, q) < k
    return q[keep], at[keep], value[keep]


def _top(names: np.ndarray, grid: np.ndarray, ids: np.ndarray, own: np.ndarray, k: int, digits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, key, similarity) of the k best of some vectors for each query, ties by key."""
    near = np.round(grid @ own.T, digits)
    near[(names[:, None] == ids[None, :]) | np.isnan(near)] = -np.inf
    least = np.partition(near, -k, axis=1)[:, -k] if k < len(ids) else np.full(len(names), -np.inf)
    q, at = np.nonzero((near >= least[:, None]) & np.isfinite(near))
    value = near[q, at]
    order = np.lexsort((ids[at], -value, q))
    q, at, value = q[order], at[order], value[order]
    # of equal ones at the end only as many as there is room for
    keep = np.arange(len(q)) - np.searchsorted(q, q) < k
    return names[q[keep]], ids[at[keep]], value[keep]


def _unit(rows: np.ndarray) -> np.ndarray:
    size = np.sqrt((rows * rows).sum(axis=1, keepdims=True))
    return rows / np.where(size > 0, size, np.nan)
