"""Sharding: a reproducible shuffle whose shard and slot can be computed.

Rows get global numbers 0..N-1 in a fixed order, a Feistel permutation of
0..N-1 shuffles the numbers, and the shuffled number's remainder and quotient
by the shard count are the shard and the slot.  Counts of shards differ by
one row at most (the ``rows`` law), and slots have no gaps.

For ``digest`` the order is by a hash bucket of the row's key columns, then by
those columns.  It depends on the rows alone, not on partitions: a lost executor's
work gives the same numbers again.  Narrow rows of the keys are written once
and numbered within their bucket.  Buckets are counted first (map-side sums),
and their counts are put in order in two steps, so that the single task of the
last one has a line for each ``BUCKET_ROWS * BUCKETS`` rows.

``assign_shards`` numbers whole rows as they are written, so they stay in place.

Rows that are equal in all key columns would share a bucket.  Where one key
has more than ``BUCKET_ROWS`` rows, they are dealt into several buckets.

The permutation works on pairs (left, right) of Z_a x Z_b with a*b >= N and
a*b - N < a, alternating sides.  Results beyond N-1 walk on along their
cycle; there are fewer than a of them.

Defined cases: null text has size 16 and CRC 0; null ids sort first; repeated
rows get different slots; an empty table gives an empty result; other columns
are kept by ``assign_shards``, but ``shard`` and ``slot`` are replaced.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from .shared import BROADCAST_ROWS, private, written

ROUNDS = 6
ROW_BYTES = 16
#: Rows that one numbering bucket holds on average.
BUCKET_ROWS = 20_000
#: Buckets whose counts are summed up before they are put in order.
BUCKETS = 1000
#: Steps of a cycle walk.  A walk has fewer steps than a, so domains of up to
#: WALK**2 rows always end in time; above, a step stays outside with a chance
#: under 1/sqrt(N), and a walk that doesn't end raises an error.
WALK = 64
#: Bits of monotonically_increasing_id that are a row's place in its partition.
_PLACE_BITS = 33


def feistel_sides(n: int) -> tuple[int, int]:
    a = max(1, math.isqrt(n))
    if a * a < n:
        a += 1
    return a, max(1, -(-n // a))


def _rounds(x: Column, a: int, b: int, seed: int) -> Column:
    left, right = F.floor(x / F.lit(b)).cast("long"), F.pmod(x, F.lit(b))
    for i in range(ROUNDS):
        size, other = (a, right) if i % 2 == 0 else (b, left)
        f = F.pmod(F.xxhash64(F.lit(f"{seed}:{i}"), other), F.lit(size))
        if i % 2 == 0:
            left = F.pmod(left + f, F.lit(size))
        else:
            right = F.pmod(right + f, F.lit(size))
    return left * F.lit(b) + right


def permute(x: Column, n: int, seed: int) -> Column:
    """The shuffled number of row number x (both in 0..n-1)."""
    a, b = feistel_sides(n)
    once = _rounds(x, a, b, seed)
    if a * b == n:
        return once
    walked = F.aggregate(F.sequence(F.lit(1), F.lit(WALK)), once, lambda y, _: F.when(y < n, y).otherwise(_rounds(y, a, b, seed)))
    out = F.when(once < n, once).otherwise(walked)
    return F.when(out < n, out).otherwise(F.raise_error(F.lit("cycle walk did not end")).cast("long"))


def _before(counts: DataFrame, key: str, out: str) -> DataFrame:
    """(key, rows before it) of a table (key, n), in the order of whole-number keys, summed up in two steps."""
    grouped = counts.withColumn("_group", F.floor(F.col(key) / BUCKETS))
    sums = grouped.groupBy("_group").agg(F.sum("n").alias("_s"))
    sums = sums.select("_group", (F.sum("_s").over(Window.orderBy("_group")) - F.col("_s")).alias("_s"))
    own = F.sum("n").over(Window.partitionBy("_group").orderBy(key)) - F.col("n")
    return grouped.withColumn(out, own).join(sums, "_group").select(key, (F.col(out) + F.col("_s")).alias(out))


def global_numbers(rows: DataFrame, keys: list[str], number: str) -> tuple[DataFrame, int]:
    """Number written rows 0..N-1 by (hash bucket of keys, keys); returns the numbered rows and N."""
    n = rows.count()
    salt, bucket, inside, before = private(rows, "salt", "bucket", "inside", "before")
    buckets = max(1, -(-n // BUCKET_ROWS))
    placed = rows.withColumn(bucket, F.pmod(F.xxhash64(*keys), F.lit(buckets)))
    full = placed.groupBy(bucket).agg(F.count("*").alias("n")).where(F.col("n") > 2 * BUCKET_ROWS).select(bucket)
    if not full.isEmpty():
        # keys with so many rows are BROADCAST_ROWS at most, and looked for in full buckets only
        least = max(BUCKET_ROWS, n // BROADCAST_ROWS)
        named = [F.col(k).alias(f"_{i}") for i, k in enumerate(keys)]
        many = placed.join(F.broadcast(full), bucket, "left_semi").groupBy(*named).agg(F.ceil(F.count("*") / F.lit(BUCKET_ROWS)).alias(salt)).where(F.col(salt) > least // BUCKET_ROWS)
        same = [F.col(k).eqNullSafe(F.col(f"_{i}")) for i, k in enumerate(keys)]
        dealt = placed.join(F.broadcast(many), same, "left").drop(*[f"_{i}" for i in range(len(keys))])
        dealt = dealt.withColumn(salt, F.pmod(F.monotonically_increasing_id(), F.coalesce(F.col(salt), F.lit(1))))
        moved = F.when(F.col(salt) == 0, F.col(bucket)).otherwise(F.pmod(F.xxhash64(*keys, F.col(salt)), F.lit(buckets)))
        placed = written(dealt.withColumn(bucket, moved).drop(salt), "sharding-buckets")
    offsets = _before(placed.groupBy(bucket).agg(F.count("*").alias("n")), bucket, before)
    numbered = placed.withColumn(inside, F.row_number().over(Window.partitionBy(bucket).orderBy(*keys)))
    offsets = F.broadcast(offsets) if buckets <= BROADCAST_ROWS else offsets
    return numbered.join(offsets, bucket).withColumn(number, F.col(before) + F.col(inside) - 1).drop(bucket, inside, before), n


def assign(rows: DataFrame, keys: list[str], shards: int, seed: int = 0) -> DataFrame:
    """Add shard (int) and slot (long) to narrow written rows by the Feistel shuffle of their global numbers."""
    number, mixed = private(rows, "number", "mixed")
    numbered, n = global_numbers(rows, keys, number)
    out = numbered.withColumn(mixed, permute(F.col(number), max(1, n), seed))
    shard = F.pmod(F.col(mixed), F.lit(shards))
    return out.withColumns({"shard": shard.cast("int"), "slot": F.floor((F.col(mixed) - shard) / F.lit(shards)).cast("long")}).drop(number, mixed)


def _size() -> Column:
    return (F.coalesce(F.octet_length("text"), F.lit(0)) + F.lit(ROW_BYTES)).cast("long")


def _crc() -> Column:
    return F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).cast("long")


def digest(docs: DataFrame, shards: int = 40, seed: int = 0) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) of every document, by the ``rows`` law."""
    narrow = written(docs.select(F.col("doc_id").cast("long").alias("doc_id"), _size().alias("size"), _crc().alias("text_crc32")), "sharding-keys")
    out = assign(narrow, ["doc_id", "text_crc32", "size"], shards, seed)
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast(T.IntegerType()).alias("grown_shard"))


def assign_shards(docs: DataFrame, shards: int = 40, seed: int = 0) -> DataFrame:
    """docs with shard and slot, without a shuffle of its rows at any size.

    docs is written with the place of each row, its partition and its place in
    it.  A row's global number is what lies in the partitions before plus its
    place; these counts have a line for each written partition and are all that
    is joined.  The written table fixes the numbers: a lost executor's work
    gives the same ones again.
    """
    own = [c for c in docs.columns if c.lower() not in ("shard", "slot")]
    row, part, before, mixed = private(docs, "row", "part", "before", "mixed")
    base = written(docs.select(*own, F.monotonically_increasing_id().alias(row)), "sharding-rows")
    placed = base.withColumn(part, F.shiftright(row, _PLACE_BITS))
    counts = written(placed.groupBy(part).agg(F.count("*").alias("n")), "sharding-counts")
    n = counts.agg(F.sum("n").alias("n")).first()["n"] or 0
    offsets = _before(counts, part, before)
    offsets = F.broadcast(offsets) if counts.count() <= BROADCAST_ROWS else offsets
    number = F.col(before) + F.col(row).bitwiseAND(F.lit((1 << _PLACE_BITS) - 1))
    shuffled = placed.join(offsets, part).withColumn(mixed, permute(number, max(1, n), seed))
    shard = F.pmod(F.col(mixed), F.lit(shards))
    return shuffled.select(*own, shard.cast("int").alias("shard"), F.floor((F.col(mixed) - shard) / F.lit(shards)).cast("long").alias("slot"))
