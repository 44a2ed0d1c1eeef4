"""Which of many terms a text holds: an index of terms by their rarest part, joined to the words of the texts.

A term is held where it stands anywhere in the text, inside a word too.  Trying
every term on every text grows with their product.  Up to ``FEW`` terms go to
all tasks, where each text is searched for the grams of terms at once
(``searched``); nothing is shuffled then.  For more terms

1. texts and terms are cut at white space, and texts' words are counted;
2. each part of a term meets the words that hold it: both are cut into grams of
   ``GRAM`` characters, for parts that are long enough of ``LONG`` (shorter ones
   are their own gram), a part is looked up by the rarest of its grams only, and
   what meets is verified;
3. a term of one part is held by every text with such a word, so each word
   keeps the best of these terms only.  A term of several parts is looked up by
   the part that the fewest texts hold, and verified on the whole text;
4. each text takes the best term by the given order.

Words, grams and matches are tables throughout, so neither terms nor texts need
fit anywhere; the words of texts and of terms, which several steps read, are
written in the working folder.  Grams and words that stand in many rows are dealt
into slices of ``SLICE`` rows, with the other side in each of them.  Texts that
are equal are matched once.

Defined cases: null and empty texts hold nothing; null terms and terms without
a visible character are left out; terms that are equal count once, the first by
order; ties of the order are broken by the term; white space within terms must
stand in the text as it is in the term.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assayframe.sources.sinks import kept

GRAM, LONG = 3, 8
#: Terms up to which all of them go to every task; rows of a key that a task holds; characters of a text whose grams are held at once.
FEW, SLICE, STRETCH = 20_000, 100_000, 1 << 16
_BLANK = r"[\s ]+"


def _parts(text: Column) -> Column:
    """The distinct words between white space."""
    return F.array_distinct(F.filter(F.split(text, _BLANK), lambda x: x != ""))


def _grams(words: DataFrame, word: str, shorter: bool) -> DataFrame:
    """(word, gram): the distinct grams of each word, of ``GRAM`` and of ``LONG`` characters and, if asked for, of fewer than ``GRAM``."""
    sizes = [*range(1 if shorter else GRAM, GRAM + 1), LONG]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                pairs = [(w, g) for w in batch.column(0).slice(at, 1024).to_pylist() for g in {w[i : i + n] for n in sizes for i in range(len(w) - n + 1)}]
                yield pa.RecordBatch.from_arrays([pa.array([p[0] for p in pairs], pa.string()), pa.array([p[1] for p in pairs], pa.string())], ["word", "gram"])

    return words.select(word).mapInArrow(run, "word string, gram string")


def _own_grams(part: Column) -> Column:
    """The grams by which a part may be looked up."""
    n = F.length(part)
    of = lambda size: F.array_distinct(F.transform(F.sequence(F.lit(1), F.greatest(n - (size - 1), F.lit(1))), lambda i: part.substr(i, F.lit(size))))
    return F.when(n < GRAM, F.array(part)).when(n < LONG, of(GRAM)).otherwise(of(LONG))


def _met(many: DataFrame, few: DataFrame, key: str, counts: DataFrame, deal: str) -> DataFrame:
    """many joined with few by a key; keys of more than ``SLICE`` rows (counts: key, n) are dealt into slices by a column of many."""
    often = F.broadcast(counts.where(F.col("n") > SLICE).select(key, F.ceil(F.col("n") / SLICE).cast("long").alias("_slices")))  # a SLICE-th of all rows at most
    slices = F.coalesce("_slices", F.lit(1).cast("long"))
    left = many.join(often, key, "left").withColumn("_slice", F.pmod(F.xxhash64(deal), slices)).drop("_slices")
    right = few.join(often, key, "left").withColumn("_slice", F.explode(F.sequence(F.lit(0).cast("long"), slices - 1))).drop("_slices")
    return left.join(right, [key, "_slice"]).drop("_slice")


def part_words(parts: DataFrame, words: DataFrame, shorter: bool = True) -> DataFrame:
    """(part, word) where a word holds a part: parts is a table of distinct parts, words one of distinct words."""
    grams = _grams(words, "word", shorter)
    asked = parts.select("part", F.explode(_own_grams(F.col("part"))).alias("gram"))
    counts = kept(grams.groupBy("gram").agg(F.count("*").alias("n")), "grams-of-words")
    of_parts = asked.groupBy("gram").agg(F.count("*").alias("n"))
    # a part with a gram that no word has is in no word
    known = _met(asked, counts.withColumnRenamed("n", "_n"), "gram", of_parts, "part")
    rarest = known.groupBy("part").agg(F.min_by("gram", F.struct("_n", "gram")).alias("gram"))
    return _met(grams, rarest, "gram", counts, "word").where(F.contains("word", F.col("part"))).select("part", "word")


def _finder(terms: Sequence[str]) -> Callable[[str], str | None]:
    """A function that finds the first of some terms that a text holds.

    Each term is looked up by one of its grams, the one that the fewest terms
    have; only terms whose gram stands in the text are searched for.
    """
    size = lambda t: LONG if len(t) >= LONG else min(len(t), GRAM)
    own = [{t[i : i + size(t)] for i in range(len(t) - size(t) + 1)} for t in terms]
    often = Counter(g for grams in own for g in grams)
    places: dict[int, dict[str, list[int]]] = {}
    for place, grams in enumerate(own):
        gram = min(grams, key=lambda g: (often[g], g))
        places.setdefault(len(gram), {}).setdefault(gram, []).append(place)
    names = {n: set(found) for n, found in places.items()}

    def first(text: str) -> str | None:
        maybe: set[int] = set()
        for n, known in names.items():
            for at in range(0, len(text) - n + 1, STRETCH):
                for gram in known & {text[i : i + n] for i in range(at, min(at + STRETCH, len(text) - n + 1))}:
                    maybe.update(places[n][gram])
        return next((terms[i] for i in sorted(maybe) if terms[i] in text), None)

    return first


def _listed(terms: DataFrame, term: str, order: Sequence[Column]) -> DataFrame:
    """(term, rank): each term with a visible character once, by its first place in the order."""
    rank = F.struct(*[c.alias(f"o{i}") for i, c in enumerate(order)], F.col(term).alias("term"))
    return terms.where(F.col(term).isNotNull() & (F.size(_parts(F.col(term))) > 0)).groupBy(F.col(term).alias("term")).agg(F.min(rank).alias("rank"))


def searched(df: DataFrame, text: Column, best: Sequence[str], out: str) -> DataFrame:
    """df with the first of a list of terms that a text holds, by one pass over it; the terms go to all tasks."""
    shared = df.sparkSession.sparkContext.broadcast(list(best))

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        first = _finder(shared.value)
        for batch in batches:
            yield pd.Series([None if x is None else first(x) for x in batch], dtype=object)

    return df.withColumn(out, F.pandas_udf(run, "string")(text))


def best_terms(texts: DataFrame, text: str, terms: DataFrame, term: str, order: Sequence[Column]) -> DataFrame:
    """(key, term): the best term of each distinct text that holds one; key is the text's SHA-256."""
    listed = _listed(terms, term, order).withColumn("parts", _parts(F.col("term")))
    # a term with white space at an end, or more than one part, isn't told by its words alone
    listed = listed.withColumn("lone", F.element_at("parts", 1) == F.col("term"))
    own = texts.where(F.col(text).isNotNull()).select(F.unhex(F.sha2(F.col(text), 256)).alias("key"), F.col(text).alias("text")).dropDuplicates(["key"])
    said = kept(own.select("key", F.explode(_parts(F.col("text"))).alias("word")), "words-of-texts")
    words = kept(said.groupBy("word").agg(F.count("*").alias("n")), "words")
    asked = listed.select("term", "rank", "lone", F.explode("parts").alias("part"))
    parts = asked.select("part").distinct()
    held = kept(part_words(parts, words), "words-of-terms")

    single = asked.where("lone").join(held, "part").groupBy("word").agg(F.min("rank").alias("rank"))
    by_word = _met(said, single, "word", words, "key").groupBy("key").agg(F.min("rank").alias("rank"))

    several = asked.where(~F.col("lone"))
    rare = held.join(words, "word").groupBy("part").agg(F.sum("n").alias("texts"))
    # a part that no word holds has no row here: its term is nowhere
    whole = several.groupBy("term").agg(F.count("*").alias("n"))
    found = several.join(rare, "part").groupBy("term").agg(F.min("rank").alias("rank"), F.count("*").alias("found"), F.min_by("part", F.struct("texts", "part")).alias("part"))
    anchors = found.join(whole, "term").where("found = n").select("term", "rank", "part")
    at_words = anchors.join(held, "part").select("word", "term", "rank")
    maybe = _met(said, at_words, "word", words, "key").groupBy("key").agg(F.collect_set(F.struct("rank", "term")).alias("maybe"))
    verified = own.join(maybe, "key").select("key", F.array_min(F.transform(F.filter("maybe", lambda m: F.contains(F.col("text"), m["term"])), lambda m: m["rank"])).alias("rank"))
    best = by_word.unionByName(verified.where(F.col("rank").isNotNull())).groupBy("key").agg(F.min("rank").alias("rank"))
    return best.select(F.lower(F.hex("key")).alias("key"), F.col("rank.term").alias("term"))


def with_best_term(df: DataFrame, text: str | Column, terms: DataFrame, term: str, order: Sequence[Column], out: str | None = None) -> DataFrame:
    """df with the best of a table's terms that a text holds, NULL if there is none."""
    value = F.col(text) if isinstance(text, str) else text
    few = [r["term"] for r in _listed(terms, term, order).orderBy("rank").limit(FEW + 1).select("term").collect()]
    if len(few) <= FEW:
        return searched(df, value, few, out or term)
    found = best_terms(df.select(value.alias("_text")), "_text", terms, term, order).withColumnRenamed("term", "_term")
    name = out or term
    base = df.drop(name) if name in df.columns else df
    return base.withColumn("_key", F.sha2(value, 256)).join(found, F.col("_key") == F.col("key"), "left").drop("_key", "key").withColumnRenamed("_term", name)


def longest_first(term: str) -> list[Column]:
    """The order by which longer terms are better."""
    return [-F.length(term)]
