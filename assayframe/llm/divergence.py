"""Source divergence audit: how far the words of each source of a language are from those of the others.

Each language keeps the terms that stand in at least ``LEAST`` of its documents.
A source's (and a language's) probability of a kept term is the whole number
p = 1 + floor(SCALE * (count + 1) / (N + V)), and its divergence from q is
floor((p - q)**2 / q).  All of it is whole-number arithmetic.

Counting: every batch of documents counts its terms by language and source, Spark
sums the counts up and joins them to the kept terms of the language, which get
a number.

Pairs: the terms of each language are dealt into blocks by hash, its sources into
seats of ``SEAT_GROUPS``.  A source's counts in one block are one compressed
vector.  Those stay where they are, in the partitions of their block and seat,
while copies travel: in each round of a round-robin tournament every seat meets
another one, the visitor's vectors are sent to the host's partition, and a
meeting gives the sums of all pairs of sources in both directions.  With S seats
there are S - 1 rounds, and a task holds two seats' vectors of a block.  Terms
that neither of two sources has are not looked at: each adds the same value.

Terms: each task keeps a heap of the best ``TOP`` terms of each group that it
meets; the heaps are merged by rank.

Defined cases: null text, lang and source are empty texts; a group without kept
terms takes part with N = 0; a language without kept terms has V = 0, pairs of
value 0 and no terms; a source that is alone has no pairs; equal values are
ordered by the item's UTF-8; repeated rows count each; long texts are counted
whole; an empty table gives an empty result; other columns are ignored.  Counts
beyond 9e13 words a language raise an error.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .shared import looked_up, map_batches, written

LEAST, SCALE, PSEUDO, TOP = 3, 1_000_000_000, 1, 200
#: Kept terms of a language in one block, on average; sources of a seat.
BLOCK_TERMS, SEAT_GROUPS = 1 << 15, 8
#: Words of a language up to which the arithmetic in two steps fits 64 bits.
MOST = 90_000_000_000_000
#: Distinct terms that a task counts, and rows of heaps that it holds, before it passes them on.
HELD = 1 << 19
#: Rounds whose meetings are written together.
ROUNDS = 8
_TERM = re.compile(rb"[a-z\x80-\xff]+")


def counted(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs): partial counts by task; the term of a group without any is null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words: dict[tuple[str, str], Counter] = {}
        held: dict[tuple[str, str], Counter] = {}

        def told() -> Iterator[pa.RecordBatch]:
            for (lang, source), own in words.items():
                n, docs_of = len(own) + 1, held[lang, source]
                terms = pa.array([None, *own], pa.binary()).cast(pa.string())
                columns = [pa.repeat(lang, n), pa.repeat(source, n), terms, pa.array([0, *own.values()]), pa.array([0, *map(docs_of.__getitem__, own)])]
                yield pa.RecordBatch.from_arrays(columns, ["lang", "source", "term", "n", "docs"])
            words.clear()
            held.clear()

        size = 0
        for batch in batches:
            for lang, source, text in zip(*(batch.column(i) for i in range(3)), strict=True):
                # lower() of bytes changes A-Z alone
                own = _TERM.findall(text.as_buffer().to_pybytes().lower())
                group = lang.as_py(), source.as_py()
                before = words.setdefault(group, Counter())
                size -= len(before)
                before.update(own)
                size += len(before)
                held.setdefault(group, Counter()).update(set(own))
                if size > HELD:
                    yield from told()
                    size = 0
        yield from told()

    plain = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    return map_batches(plain, run, "lang string, source string, term string, n long, docs long")


def _div(a: Column, b: Column) -> Column:
    return F.call_function("div", a, b)


def share(n: Column, total: Column) -> Column:
    """1 + floor(SCALE * (n + PSEUDO) / total) without leaving 64 bits: the scale is multiplied in two steps."""
    x, step = (n.cast("long") + F.lit(PSEUDO)) * F.lit(10_000), F.lit(SCALE // 10_000)
    return F.lit(1) + _div(x, total) * step + _div(F.pmod(x, total) * step, total)


def shares(n: np.ndarray, total: int) -> np.ndarray:
    x = (n + PSEUDO) * 10_000
    return 1 + x // total * (SCALE // 10_000) + x % total * (SCALE // 10_000) // total


def _packed(ids: np.ndarray, counts: np.ndarray) -> bytes:
    """A vector of a block: its terms' numbers as differences, and their counts."""
    order = np.argsort(ids)
    return zlib.compress(np.concatenate([np.diff(ids[order], prepend=0), counts[order]]).tobytes(), 1)


def _unpacked(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    both = np.frombuffer(zlib.decompress(data), np.int64)
    return np.cumsum(both[: len(both) // 2]), both[len(both) // 2 :]


def partner(seat: int, turn: int, seats: int) -> int:
    """Whom a seat meets in a round of the tournament (seats are even in number; the last one stays, the others rotate)."""
    if seat == seats - 1:
        return turn
    other = (2 * turn - seat) % (seats - 1)
    return seats - 1 if other == seat else other


def host(a: int, b: int) -> int:
    """Which of two seats a meeting takes place at: each is host about as often as guest."""
    return min(a, b) if (a + b) % 2 else max(a, b)


def met(a: list, b: list, same: bool) -> list[tuple]:
    """(lang, source, item, value, terms) of both directions of all pairs; a and b are lists of (lang, source, total, packed vector).

    value is summed over the terms that one of the two sources has in this block, terms is their number.
    """
    vectors = [(x[1], x[2], *_unpacked(x[3])) for x in (a if same else a + b)]
    ids = np.unique(np.concatenate([x[2] for x in vectors]))
    p, has = np.zeros((len(vectors), len(ids)), np.int64), np.zeros((len(vectors), len(ids)), bool)
    for row, own_has, (_, total, own, n) in zip(p, has, vectors, strict=True):
        if total:
            at = np.searchsorted(ids, own)
            row[:] = shares(np.zeros(1, np.int64), total)
            row[at], own_has[at] = shares(n, total), True
    out = []
    for i in range(len(a)):
        for j in range(i + 1, len(a)) if same else range(len(a), len(vectors)):
            either = np.flatnonzero(has[i] | has[j])
            x, y = p[i][either], p[j][either]
            square = ((x - y) ** 2).astype(np.uint64)
            for first, second, q in ((i, j, y), (j, i, x)):
                value = int((square // q.astype(np.uint64)).sum()) if len(either) else 0
                out.append((a[0][0], vectors[first][0], vectors[second][0], value, len(either)))
    return out


_ROWS = "lang string, source string, item string, value long, terms long"


def _meeting(first: bool):
    names = [x.split()[0] for x in _ROWS.split(", ")]

    def run(own: pa.Table, guests: pa.Table) -> pa.Table:
        a, b = ([tuple(x.values()) for x in t.select(["lang", "source", "total", "vector"]).to_pylist()] for t in (own, guests))
        rows = met(a, [], True) if first and a else []
        rows += met(a, b, False) if a and b else []
        columns = list(zip(*rows, strict=True)) or [()] * 5
        return pa.table([pa.array(c, k) for c, k in zip(columns, (pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64()), strict=True)], names)

    return run


def tournament(residents: DataFrame, seats: int) -> DataFrame:
    """Sums of all pairs of sources of a language by block: residents are (lang, block, seat, source, total, vector)."""
    keys = ["lang", "block", "seat"]
    # the residents' partitions are made once: each round only shuffles the visitors to them
    settled = residents.repartition(int(residents.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys).persist()
    out, lot = [], None
    for turn in range(max(1, seats - 1)):
        guests = {partner(s, turn, seats): s for s in range(seats)} if seats > 1 else {}
        to = {s: h for h, s in guests.items() if host(h, s) == h}
        moves = F.create_map(*[F.lit(x) for pair in to.items() for x in pair]) if to else F.create_map(F.lit(-1), F.lit(-1))
        visitors = residents.withColumn("seat", F.element_at(moves, F.col("seat"))).where(F.col("seat").isNotNull())
        part = settled.groupBy(*keys).cogroup(visitors.groupBy(*keys)).applyInArrow(_meeting(turn == 0), _ROWS)
        lot = part if lot is None else lot.unionByName(part)
        if turn % ROUNDS == ROUNDS - 1 or turn == max(1, seats - 1) - 1:
            out.append(written(lot.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"), F.sum("terms").alias("terms")), "meetings"))
            lot = None
    settled.unpersist()
    table = out[0]
    for part in out[1:]:
        table = table.unionByName(part)
    return table


def _local_heaps(rows: DataFrame, top: int) -> DataFrame:
    """The best ``top`` rows (lang, source, item, value) of each group of each task."""
    order = {"by": ["value", "item"], "ascending": [False, True], "kind": "stable"}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heap, waiting, size = None, [], 0
        cut = lambda parts: pd.concat(parts).sort_values(**order).groupby(["lang", "source"], sort=False).head(top)
        told = lambda df: pa.RecordBatch.from_pandas(df, preserve_index=False)
        for batch in batches:
            waiting.append(batch.to_pandas())
            size += batch.num_rows
            if size >= HELD:
                heap, waiting, size = cut([*([] if heap is None else [heap]), *waiting]), [], 0
                if len(heap) > HELD:
                    yield told(heap)
                    heap = None
        if heap is not None or waiting:
            yield told(cut([*([] if heap is None else [heap]), *waiting]))

    return map_batches(rows.select("lang", "source", "item", "value"), run, "lang string, source string, item string, value long")


def _ranked(rows: DataFrame, part: str, top: int | None = None) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), F.col("item"))
    out = rows.select("lang", "source", F.lit(part).alias("part"), "item", "value", F.row_number().over(order).alias("rank"))
    return out if top is None else out.where(F.col("rank") <= top)


def audit(docs: DataFrame, least: int = LEAST, top: int = TOP, block_terms: int = BLOCK_TERMS, seat_groups: int = SEAT_GROUPS) -> DataFrame:
    """(lang, source, part, item, value, rank): divergences of each source from the others, and of its terms from its language."""
    counts = written(counted(docs).groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")), "terms")
    terms = counts.where(F.col("term").isNotNull()).groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("lang_n")).where(F.col("docs") >= least)
    kept = written(terms.select("lang", "term", "lang_n", F.monotonically_increasing_id().alias("id")), "kept")
    langs = counts.groupBy("lang").agg(F.count_distinct("source").alias("sources")).join(kept.groupBy("lang").agg(F.count("*").alias("terms"), F.sum("lang_n").alias("words")), "lang", "left").fillna(0)
    langs = written(langs.select("*", F.when(F.col("words") + F.col("terms") > MOST, F.raise_error(F.lit("too many words for exact arithmetic")).cast("long")).otherwise(F.col("words") + F.col("terms")).alias("lang_total")), "langs")
    most = langs.agg(F.max("terms").alias("terms"), F.max("sources").alias("sources")).first()
    blocks = max(1, -(-(most["terms"] or 0) // block_terms))
    seats = -(-(most["sources"] or 0) // seat_groups)
    seats += seats % 2 if seats > 1 else 0
    own = written(counts.where(F.col("term").isNotNull()).join(kept, ["lang", "term"]).select("lang", "source", "term", "n", "lang_n", "id"), "kept-counts")
    groups = counts.groupBy("lang", "source").agg(F.count("*").alias("_")).drop("_").join(own.groupBy("lang", "source").agg(F.sum("n").alias("words")), ["lang", "source"], "left").fillna(0)
    groups = looked_up(groups, "lang", langs.select("lang", "terms", "lang_total"))
    seat = F.pmod(F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1, F.lit(max(1, seats)))
    groups = written(groups.select("lang", "source", "terms", "lang_total", (F.col("words") + F.col("terms")).alias("total"), seat.cast("int").alias("seat")), "groups")

    vectors = own.groupBy("lang", "source", F.pmod(F.xxhash64("term"), F.lit(blocks)).cast("int").alias("block")).agg(F.collect_list(F.struct("id", "n")).alias("v"))
    places = groups.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))).join(vectors, ["lang", "source", "block"], "left")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none = np.zeros(0, np.int64)
        for batch in batches:
            pairs = zip(*(batch.column(i) for i in (5, 6)), strict=True)
            made = [_packed(*(none if x.values is None else x.values.to_numpy() for x in pair)) for pair in pairs]
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(made, pa.binary())], [*batch.schema.names[:5], "vector"])

    packed = map_batches(places.select("lang", "block", "seat", "source", "total", "v.id", "v.n"), pack, "lang string, block int, seat int, source string, total long, vector binary")
    sums = tournament(written(packed, "vectors"), max(1, seats))
    pair = sums.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"), F.sum("terms").alias("met"))
    zero = lambda total: F.when(F.col(total) > 0, share(F.lit(0), F.col(total))).otherwise(F.lit(1))
    pair = pair.join(groups.select("lang", "source", "terms", zero("total").alias("p")), ["lang", "source"]).join(groups.select("lang", F.col("source").alias("item"), zero("total").alias("q")), ["lang", "item"])
    gap = F.col("p") - F.col("q")
    pair = pair.withColumn("value", F.col("value") + (F.col("terms") - F.col("met")) * _div(gap * gap, F.col("q")))

    p, q = share(F.col("n"), F.col("total")), share(F.col("lang_n"), F.col("lang_total"))
    group = F.struct("lang", "source").alias("group")
    named = looked_up(own.select("*", group), "group", groups.select(group, "total", "lang_total")).select("lang", "source", F.col("term").alias("item"), p.alias("p"), q.alias("q")).where("p > q")
    heaps = _local_heaps(named.withColumn("value", _div(gap * gap, F.col("q"))), top)
    return _ranked(pair, "pair").unionByName(_ranked(heaps, "term", top))


def digest(docs: DataFrame) -> DataFrame:
    return audit(docs)


def oracle(least: int = LEAST, top: int = TOP) -> str:
    """DuckDB SQL for the rows of ``digest``."""
    lower = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    share = lambda n, total: f"(1 + ({SCALE}::HUGEINT * ({n} + {PSEUDO})) // {total})"
    value = lambda p, q: f"((({p} - {q}) * ({p} - {q})) // {q})"
    return f"""
WITH docs AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source, {lower} AS t FROM documents),
words AS (SELECT r, lang, source, unnest(regexp_extract_all(t, '[a-z\\x{{80}}-\\x{{10FFFF}}]+')) AS term FROM docs),
counts AS MATERIALIZED (SELECT lang, source, term, count(*) AS n, count(DISTINCT r) AS d FROM words GROUP BY ALL),
kept AS MATERIALIZED (SELECT lang, term, sum(n)::BIGINT AS n FROM counts GROUP BY ALL HAVING sum(d) >= {least}),
langs AS (SELECT lang, count(*) AS v, sum(n)::BIGINT AS n FROM kept GROUP BY lang),
own AS MATERIALIZED (SELECT lang, source, term, counts.n AS n FROM counts JOIN kept USING (lang, term)),
groups AS MATERIALIZED (SELECT g.lang, g.source, coalesce(any_value(langs.v), 0) AS v, coalesce(sum(own.n), 0)::BIGINT AS n
    FROM (SELECT DISTINCT lang, source FROM docs) g LEFT JOIN own USING (lang, source) LEFT JOIN langs ON g.lang = langs.lang GROUP BY g.lang, g.source),
grid AS MATERIALIZED (SELECT g.lang, g.source, kept.term, {share("coalesce(own.n, 0)", "(g.n + g.v)")} AS p FROM groups g JOIN kept USING (lang) LEFT JOIN own ON own.lang = g.lang AND own.source = g.source AND own.term = kept.term),
pair AS (SELECT a.lang, a.source, b.source AS item, coalesce(sum({value("x.p", "y.p")}), 0)::BIGINT AS value FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN grid x ON x.lang = a.lang AND x.source = a.source LEFT JOIN grid y ON y.lang = b.lang AND y.source = b.source AND y.term = x.term GROUP BY ALL),
term AS (SELECT own.lang, own.source, own.term AS item, {share("own.n", "(g.n + g.v)")} AS p, {share("kept.n", "(langs.n + langs.v)")} AS q
    FROM own JOIN groups g USING (lang, source) JOIN kept USING (lang, term) JOIN langs USING (lang)),
rows_of AS (SELECT lang, source, 'pair' AS part, item, value FROM pair UNION ALL SELECT lang, source, 'term', item, {value("p", "q")}::BIGINT FROM term WHERE p > q)
SELECT lang, source, part, item, value, rank FROM (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank FROM rows_of)
WHERE part = 'pair' OR rank <= {top}"""
