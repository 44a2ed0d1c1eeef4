"""Joins with stated cardinality, membership, containment and previous periods."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from assayframe.functions.text import ngrams
from assayframe.sources.sinks import kept

from .dedupe import keep_first
from .terms import best_terms, with_best_term

#: Terms up to which each is tried on every row; more are looked up by an index.
FEW_TERMS = 100
#: Rows up to which a table of terms or lookup values is broadcast.
SMALL_ROWS = 200_000
#: Shared words (one for each group) up to which they go to all tasks.
SHARED_WORDS = 1_000_000
#: Rows of a join of large tables up to which Spark deals them out by itself; rows that a task takes of more.
FEW_ROWS, TASK_ROWS = 1_000_000, 250_000


def small(df: DataFrame, most: int = SMALL_ROWS) -> DataFrame:
    """Broadcast a table if it has no more than ``most`` rows (one bounded count); else leave it to be shuffled."""
    return F.broadcast(df) if df.limit(most + 1).count() <= most else df


def repeated_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).count().where("count > 1")


def many_to_one(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left join to a table with unique keys; a ValueError if they are not."""
    if not repeated_keys(right, keys).isEmpty():
        raise ValueError(f"keys {list(keys)} are not unique on the right side")
    return left.join(right, list(keys), "left")


def in_tasks(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Inner join of tables that may both be large, in tasks of about ``TASK_ROWS`` rows of the larger one.

    There are more tasks for more rows (one count of each table), so what a
    task sorts, and what aggregates after the join hold in it, stays as it is.
    Tasks that scan the tables hold at most their split's rows to deal them out.
    A key with more rows than that is one task's work, with its rows on disk
    where they don't fit.
    """
    rows = max(left.count(), right.count())
    if rows <= FEW_ROWS:
        return left.join(right, key)
    parts = -(-rows // TASK_ROWS)
    return left.repartition(parts, key).join(right.repartition(parts, key).hint("merge"), key)


def lookup(df: DataFrame, table: DataFrame, key: str, columns: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Left join to the first row of each key of a table; equal names on the left are replaced."""
    first = keep_first(table, [key], order).select(key, *columns)
    return df.drop(*columns).join(first, key, "left")


def enrich_from_shards(df: DataFrame, shards: Sequence[DataFrame], key: str, columns: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Left join to the union of shard tables, the first row of a key kept (``shards`` has the way for many and large ones)."""
    table = shards[0]
    for s in shards[1:]:
        table = table.unionByName(s, allowMissingColumns=True)
    return lookup(df, table, key, columns, order)


def not_in(df: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Rows whose key isn't in a ledger; a missing key equals a missing key."""
    keys = done.select(F.col(key).alias("_done")).distinct()
    return df.join(keys, F.col(key).eqNullSafe(F.col("_done")), "left_anti")


def top_values(df: DataFrame, column: str, n: int) -> DataFrame:
    """The n most frequent values, ties by value."""
    return df.where(F.col(column).isNotNull()).groupBy(column).count().orderBy(F.desc("count"), column).limit(n).select(column)


def in_top(df: DataFrame, column: str, n: int) -> DataFrame:
    """Rows whose value is among the n most frequent."""
    return df.join(F.broadcast(top_values(df, column, n)), column, "left_semi")


def first_contained(df: DataFrame, text: str, terms: DataFrame, term: str, order: Sequence[str]) -> DataFrame:
    """Left join to the first of a table's terms, in order, that the text holds.

    Up to ``FEW_TERMS`` terms are grouped into one array that is carried to
    every row; more are looked up by an index (see ``terms``).
    """
    if terms.limit(FEW_TERMS + 1).count() > FEW_TERMS:
        return with_best_term(df, text, terms, term, [F.col(c) for c in order])
    listed = terms.agg(F.array_sort(F.collect_list(F.struct(*order, F.col(term).alias("_term")))).alias("_terms"))
    found = F.filter("_terms", lambda t: F.contains(F.col(text), t["_term"]))
    joined = df.join(F.broadcast(listed), F.lit(True), "left")
    return joined.withColumn(term, F.get(found, 0)["_term"]).drop("_terms")


def longest_contained(text: Column, terms: Sequence[str]) -> Column:
    """The longest of the terms that the text holds, the first in order of equal ones; NULL if none."""
    ranked = sorted(range(len(terms)), key=lambda i: (-len(terms[i]), i))
    return F.coalesce(*[F.when(F.contains(text, F.lit(terms[i])), F.lit(terms[i])) for i in ranked])


def previous_year(df: DataFrame, keys: Sequence[str], year: str, columns: Sequence[str]) -> DataFrame:
    """Left join of each row to its keys' row of the calendar year before: ``prev_*`` columns."""
    before = df.select(*keys, (F.col(year) + 1).alias(year), *[F.col(c).alias(f"prev_{c}") for c in columns])
    return df.join(before, [*keys, year], "left")


def previous_listed(df: DataFrame, keys: Sequence[str], period: str, columns: Sequence[str]) -> DataFrame:
    """``prev_*`` columns of the period listed before, whatever lies between."""
    order = Window.partitionBy(*keys).orderBy(period)
    return df.withColumns({f"prev_{c}": F.lag(c).over(order) for c in columns})


def shared_ngrams(grams: DataFrame, group: str, gram: str, base: str) -> DataFrame:
    """n-grams that a base group shares with others: (gram, groups), groups sorted."""
    return grams.select(group, gram).distinct().groupBy(gram).agg(F.array_sort(F.collect_set(group)).alias("groups")).where((F.size("groups") > 1) & F.array_contains("groups", base))


def shared_ngrams_to(df: DataFrame, group: str, tokens: Column, most: int, base: str, stop: Sequence[str] = ()) -> DataFrame:
    """n-grams of 1 to ``most`` words that a base group shares with others, as of ``shared_ngrams``.

    What two groups share has only parts that both share, so words come first,
    and longer n-grams are looked up by their words before they are dealt out
    (up to ``SHARED_WORDS`` shared words, which go to all tasks; without that
    beyond).
    """
    rows = df.where(F.col(group).isNotNull()).select(F.col(group).alias("_group"), tokens.alias("_words"))
    listed = lambda sizes: F.explode(F.array_distinct(F.concat(*[ngrams(F.col("_words"), n, stop) for n in sizes]))).alias("_gram")
    out = kept(shared_ngrams(rows.select("_group", listed([1])), "_group", "_gram", base), "shared-words")
    if most > 1:
        words = out.select(F.explode("groups").alias("_group"), F.col("_gram").alias("_word"))
        longer = rows.select("_group", listed(range(2, most + 1)))
        if words.count() <= SHARED_WORDS:
            own = F.split("_gram", " ")
            for i in range(most):
                longer = longer.withColumn("_word", F.coalesce(F.get(own, i), F.get(own, 0))).join(F.broadcast(words), ["_group", "_word"], "left_semi").drop("_word")
        out = out.unionByName(shared_ngrams(longer, "_group", "_gram", base))
    return out.withColumnRenamed("_gram", "gram")


def known_terms(df: DataFrame, columns: Sequence[str], terms: Sequence[str], spellings: Mapping[str, str], out: str) -> DataFrame:
    """Rows one of whose columns holds a known term (any case), with the longest one in all columns, by its usual spelling.

    Up to ``FEW_TERMS`` terms are branches of one expression; more are looked
    up by an index (see ``terms``), and their spellings joined.
    """
    if len(terms) > FEW_TERMS:
        return _known_many(df, columns, terms, spellings, out)
    pattern = "(?i)" + "|".join(f"\\Q{t}\\E" for t in terms)
    held = F.lit(False)
    for c in columns:
        held = held | F.coalesce(F.col(c).rlike(pattern), F.lit(False))
    low = [t.lower() for t in terms]
    found = longest_contained(F.lower(F.concat_ws(" ", *[F.col(c) for c in columns])), low)
    usual = F.try_element_at(F.create_map(*[F.lit(x) for k, v in spellings.items() for x in (k.lower(), v)]), found) if spellings else F.lit(None).cast("string")
    same = F.try_element_at(F.create_map(*[F.lit(x) for k, v in zip(low, terms, strict=True) for x in (k, v)]), found)
    return df.where(held).withColumn(out, F.coalesce(usual, same))


def _known_many(df: DataFrame, columns: Sequence[str], terms: Sequence[str], spellings: Mapping[str, str], out: str) -> DataFrame:
    usual = {k.lower(): v for k, v in spellings.items()}
    rows = [(i, t.lower(), usual.get(t.lower(), t)) for i, t in enumerate(terms)]
    listed = df.sparkSession.createDataFrame(rows, "_at int, _low string, _said string")
    order = [-F.length("_low"), F.col("_at")]
    found = with_best_term(df, F.lower(F.concat_ws(" ", *[F.col(c) for c in columns])), listed, "_low", order, "_found")
    said = small(listed.groupBy(F.col("_low").alias("_found")).agg(F.min_by("_said", "_at").alias("_said")))
    found = found.where(F.col("_found").isNotNull()).join(said, "_found").drop("_found")
    # a term may lie across two columns only: rows count where one column holds a term
    texts = [F.lower(F.col(c)) for c in columns]
    every = df.select(F.explode(F.array(*texts)).alias("_text")).distinct()
    keys = best_terms(every, "_text", listed, "_low", order).select("key", F.lit(True).alias("_held"))
    for i, c in enumerate(texts):
        found = found.join(keys.select(F.col("key").alias(f"_key{i}"), F.col("_held").alias(f"_held{i}")), F.sha2(c, 256) == F.col(f"_key{i}"), "left")
    held = [F.col(f"_held{i}").isNotNull() for i in range(len(texts))]
    any_held = held[0]
    for h in held[1:]:
        any_held = any_held | h
    kept = [c for c in df.columns if c != out]
    return found.where(any_held).select(*kept, F.col("_said").alias(out))
