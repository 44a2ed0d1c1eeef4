"""Centroid clustering of whole-number vectors with exact distances, screened by block norms.

Components are turned into whole numbers, floor(scale * x), once; a table keeps
them with the norms of ``BLOCKS`` segments of each vector (its compressed form).
By Cauchy-Schwarz the squared distance to a centroid is at least the sum over
the segments of (norm of the vector's segment - norm of the centroid's)**2.  For
every vector the centroid with the least bound gets an exact distance first;
then only those whose bound doesn't pass the best distance so far.  Bounds are
taken a little lower than floating point gives them, so no centroid is lost to
rounding, and of equal distances the smaller number is taken.

A round is one pass over that table: each batch adds up its vectors by cluster,
Spark sums these up, and the driver gets k rows of sums.  Sums are exact: whole
numbers, in Python's own on the driver.

Defined cases: vectors that are null, have another number of components, or
null or non-finite ones are left out; components beyond 2**26 raise an error, as
sums of squares would not fit 64 bits; fewer vectors than centroids give as many
clusters as there are vectors; equal vectors at the start leave the larger
numbers empty, and empty clusters keep their centroid; repeated rows count each;
null ids are kept, and are the start of a cluster only if too few others are
there; an empty table gives an empty result; other columns are kept by
``assigned`` (those with the names of the added ones are replaced) and ignored
by ``digest``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import map_batches, private, written

SIZE, SCALE, BLOCKS = 64, 1024, 8
CLUSTERS, ROUNDS = 8, 10
LARGEST = 1 << 26
#: Rows of a batch that are looked at together.
LOT = 1 << 13


@dataclass
class Clusters:
    """Centroids, and of the last assignment the vectors and the summed distance of each."""

    centroids: np.ndarray
    counts: list[int]
    inertia: list[int]

    def sha256(self, number: int) -> str:
        return hashlib.sha256(",".join(map(str, self.centroids[number].tolist())).encode()).hexdigest()


def whole(vector: Column, size: int = SIZE, scale: int = SCALE) -> Column:
    """floor(scale * x) of every component as array<int>; null if the vector doesn't qualify."""
    x = vector.cast(T.ArrayType(T.DoubleType()))
    finite = F.forall(x, lambda v: F.coalesce(v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")), F.lit(False)))
    made = F.transform(x, lambda v: F.when(F.abs(v * scale) <= LARGEST, F.floor(v * scale).cast("int")).otherwise(F.raise_error(F.lit("a component is beyond the range of exact distances")).cast("int")))
    return F.when((F.size(x) == size) & finite, made)


def norms(vectors: np.ndarray, blocks: int = BLOCKS) -> np.ndarray:
    """Norms of the segments of each row."""
    return np.stack([np.sqrt((part.astype(np.float64) ** 2).sum(axis=1)) for part in np.array_split(vectors, blocks, axis=1)], axis=1)


def nearest(vectors: np.ndarray, compressed: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """(number of the nearest centroid, squared distance) of each row, and how many exact distances that took."""
    own = norms(centroids, compressed.shape[1])
    bound = ((compressed[:, None, :] - own[None]) ** 2).sum(axis=2) * (1 - 1e-9) - 1e-3
    first = bound.argmin(axis=1)
    best = ((vectors - centroids[first]) ** 2).sum(axis=1)
    number, asked = first.copy(), len(vectors)
    for j in range(len(centroids)):
        rows = np.flatnonzero((bound[:, j] <= best) & (first != j))
        asked += len(rows)
        distance = ((vectors[rows] - centroids[j]) ** 2).sum(axis=1)
        closer = (distance < best[rows]) | ((distance == best[rows]) & (j < number[rows]))
        best[rows[closer]], number[rows[closer]] = distance[closer], j
    return number, best, asked


def _matrix(column: pa.Array, dtype) -> np.ndarray:
    values = column.flatten().to_numpy(zero_copy_only=False)
    return values.reshape(len(column), -1).astype(dtype) if len(column) else np.zeros((0, 0), dtype)


def _lots(batch: pa.RecordBatch, vector: int, compressed: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    for at in range(0, batch.num_rows, LOT):
        part = batch.slice(at, LOT)
        yield part, _matrix(part.column(vector), np.int64), _matrix(part.column(compressed), np.float64)


def compress(vectors: DataFrame, vector: str, out: str, blocks: int = BLOCKS) -> DataFrame:
    """vectors with the norms of the segments of a column of whole numbers."""
    schema = T.StructType([*vectors.schema, T.StructField(out, T.ArrayType(T.DoubleType()))])
    at = vectors.columns.index(vector)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, LOT):
                part = batch.slice(begin, LOT)
                made = norms(_matrix(part.column(at), np.int64), blocks)
                offsets = np.arange(0, made.size + 1, blocks, dtype=np.int32)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.ListArray.from_arrays(pa.array(offsets), pa.array(made.reshape(-1)))], schema.names)

    return map_batches(vectors, run, schema)


def _sums(table: DataFrame, centroids: np.ndarray, vector: str, compressed: str) -> Clusters:
    """One pass: vectors, exact sums of components and of distances by nearest centroid, then the moved centroids."""
    k, size = centroids.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # of each cluster: the sums of its components, of its distances, and its vectors
        total = np.zeros((k, size + 2), np.int64)
        for batch in batches:
            for _, rows, short in _lots(batch, 0, 1):
                number, distance, _ = nearest(rows, short, centroids)
                for j in np.unique(number):
                    own = number == j
                    total[j] += np.r_[rows[own].sum(axis=0), distance[own].sum(), own.sum()]
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(total.size, dtype=np.int32)), pa.array(total.reshape(-1))], ["place", "total"])

    parts = map_batches(table.select(vector, compressed), run, "place int, total long")
    # decimals: what tasks' sums come to may pass 64 bits where each of them doesn't
    sums = parts.groupBy("place").agg(F.sum(F.col("total").cast("decimal(20,0)")).alias("total")).collect()  # k rows of size + 2
    total = np.zeros(k * (size + 2), object)
    for row in sums:
        total[row["place"]] = int(row["total"])
    total = total.reshape(k, size + 2)
    counts = total[:, -1].tolist()
    moved = [[x // n for x in row] if n else old for row, n, old in zip(total[:, :size].tolist(), counts, centroids.tolist(), strict=True)]
    return Clusters(np.array(moved, np.int64), counts, total[:, size].tolist())


def fit(table: DataFrame, key: str, vector: str, compressed: str, clusters: int = CLUSTERS, rounds: int = ROUNDS, seed: int = 3) -> Clusters:
    """Centroids after some rounds over a table of whole-number vectors and their norms, and the sums of the last assignment.

    They start as the vectors with the smallest SHA-256 of ``seed:key``.
    """
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")).cast("binary"), 256)
    start = table.select(order.alias("h"), F.col(vector).alias("v")).orderBy(F.col("h").asc_nulls_last(), "v").limit(clusters).collect()
    if not start:
        return Clusters(np.zeros((0, 0), np.int64), [], [])
    found = Clusters(np.array([r["v"] for r in start], np.int64), [], [])
    for _ in range(rounds):
        found = Clusters(_sums(table, found.centroids, vector, compressed).centroids, [], [])
    last = _sums(table, found.centroids, vector, compressed)
    return Clusters(found.centroids, last.counts, last.inertia)


def _assign(table: DataFrame, vector: str, compressed: str, keep: list[str], found: Clusters) -> DataFrame:
    base = table.select(*keep, vector, compressed)
    schema = T.StructType([*[table.schema[c] for c in keep], T.StructField("cluster", T.IntegerType()), T.StructField("distance", T.LongType())])
    at, centroids = len(keep), found.centroids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, rows, short in _lots(batch, at, at + 1):
                number, distance, _ = nearest(rows, short, centroids)
                yield pa.RecordBatch.from_arrays([*part.columns[:at], pa.array(number, pa.int32()), pa.array(distance)], schema.names)

    return map_batches(base, run, schema)


def _fitted(vectors: DataFrame, column: str, key: str, size: int, scale: int, clusters: int, rounds: int, seed: int, keep: list[str]) -> tuple[DataFrame, str, str, Clusters]:
    vector, compressed = private(vectors, "whole", "norms")
    base = vectors.select(*keep, *([] if key in keep else [key]), whole(F.col(column), size, scale).alias(vector)).where(F.col(vector).isNotNull())
    table = written(compress(base, vector, compressed), "centroids")
    return table, vector, compressed, fit(table, key, vector, compressed, clusters, rounds, seed)


def assigned(vectors: DataFrame, column: str = "embedding", key: str = "vec_id", size: int = SIZE, scale: int = SCALE, clusters: int = CLUSTERS, rounds: int = ROUNDS, seed: int = 3) -> tuple[DataFrame, Clusters]:
    """(vectors that qualify with their cluster and squared distance, the clusters)."""
    keep = [c for c in vectors.columns if c.lower() not in ("cluster", "distance")]
    table, vector, compressed, found = _fitted(vectors, column, key, size, scale, clusters, rounds, seed, keep)
    return (_assign(table, vector, compressed, keep, found) if len(found.centroids) else table.select(*keep, F.lit(None).cast("int").alias("cluster"), F.lit(None).cast("long").alias("distance"))), found


def digest(vectors: DataFrame, clusters: int = CLUSTERS, rounds: int = ROUNDS, seed: int = 3) -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256) of every vector that qualifies."""
    narrow = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
    out, found = assigned(narrow, clusters=clusters, rounds=rounds, seed=seed)
    pick = lambda values, kind: F.element_at(F.array(*[F.lit(x).cast(kind) for x in [*values, None]]), F.col("cluster") + 1)
    shas = [found.sha256(i) for i in range(len(found.centroids))]
    return out.select("vec_id", "cluster", "distance", pick(found.inertia, "long").alias("cluster_inertia"), F.lit(sum(found.inertia)).cast("long").alias("inertia"), pick(shas, "string").alias("centroid_sha256"))


def oracle(clusters: int = CLUSTERS, rounds: int = ROUNDS, seed: int = 3) -> str:
    """DuckDB SQL for the rows of ``digest``: the rounds written out one after another."""
    square = f"list_sum([(v[i] - c[i]) * (v[i] - c[i]) for i in range(1, {SIZE + 1})])::BIGINT"
    parts = [
        f"""kept AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id, [floor({SCALE} * x::DOUBLE)::BIGINT for x in embedding] AS v FROM embeddings
            WHERE len(embedding) = {SIZE} AND len([x for x in embedding if isfinite(x::DOUBLE)]) = {SIZE})""",
        f"c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY h, v) - 1 AS k, v AS c FROM (SELECT sha256('{seed}:' || vec_id::VARCHAR) AS h, v FROM kept ORDER BY h, v LIMIT {clusters}))",
    ]
    for i in range(rounds + 1):
        parts.append(f"a{i} AS MATERIALIZED (SELECT r, min({{'d': d, 'k': k}}) AS best FROM (SELECT r, k, {square} AS d FROM kept, c{i}) GROUP BY r)")
        if i < rounds:
            parts.append(f"""s{i} AS MATERIALIZED (SELECT k, list(m ORDER BY i) AS c FROM (SELECT best.k AS k, i, floor(sum(v[i])::HUGEINT / count(*))::BIGINT AS m
                FROM a{i} JOIN kept USING (r), (SELECT unnest(range(1, {SIZE + 1})) AS i) GROUP BY ALL) GROUP BY k)""")
            parts.append(f"c{i + 1} AS MATERIALIZED (SELECT c{i}.k AS k, coalesce(s{i}.c, c{i}.c) AS c FROM c{i} LEFT JOIN s{i} USING (k))")
    return "WITH " + ",\n".join(parts) + f"""
SELECT vec_id, best.k::INTEGER AS cluster, best.d AS distance, (sum(best.d) OVER (PARTITION BY best.k))::BIGINT AS cluster_inertia,
    (sum(best.d) OVER ())::BIGINT AS inertia, sha256(array_to_string(c, ',')) AS centroid_sha256
FROM a{rounds} JOIN kept USING (r) JOIN c{rounds} ON best.k = c{rounds}.k"""
