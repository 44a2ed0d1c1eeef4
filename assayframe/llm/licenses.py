"""License scans by diagonal voting, in DataFrame operations only.

Texts and license templates become words: A-Z lower-cased, maximal runs of
digits, letters and non-ASCII characters.  The hash of every run of k = 3
words of every text is looked up among the templates' hashes; those that are
found are joined to the templates' positions.  A hit at word p of the text
and word t of the template votes for diagonal p - t.  Votes are summed by
diagonal, diagonals at most ``GAP`` apart are merged into one span (words
inserted or left out), and a span is verified by the share of the template's
words that its hits cover, each hit checked word by word.

A template that stands word for word has one diagonal with all its votes.

The templates are a parameter.  Up to ``LITERALS`` distinct hashes are a literal
set in the scan, so that other runs of words never leave it; up to
``POSITIONS`` positions are a broadcast table.  Beyond these, counted, all runs
are joined, by a shuffle: the rows are the same.

Defined cases: null text is empty (0 words, no label); repeated rows give
repeated results; each row is treated alone, so copies and hot sources are
no groups; very long texts are one row's array; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

K = 3
GAP = 2
COVER = 0.8
LITERALS, POSITIONS = 5_000, 200_000
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Template:
    label: str
    text: str
    base: bool = False


#: The base phrases, and further phrases and opening clauses of common licenses.
TEMPLATES = (
    Template("mit", "under the mit license", True),
    Template("apache-2", "apache license version 2", True),
    Template("cc-by-nc", "cc by nc", True),
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    Template("gpl", "under the gnu general public license version"),
    Template("lgpl", "gnu lesser general public license"),
    Template("mpl", "mozilla public license version"),
    Template("cc-by-sa", "cc by sa"),
    Template("cc-by", "creative commons attribution license"),
    Template("apache-2", "licensed under the apache license version 2 0 the license"),
    Template("proprietary", "all rights reserved no part of this publication may be reproduced"),
)


def lowered(text: Column) -> Column:
    """A-Z lower-cased.  lower() does the same but for two letters whose small forms are or hold ASCII."""
    odd = text.contains("K") | text.contains("İ")
    return F.when(odd, F.translate(text, UPPER, LOWER)).otherwise(F.lower(text))


def words(text: Column) -> Column:
    return F.regexp_extract_all(lowered(F.coalesce(text, F.lit(""))), F.lit(WORD), F.lit(0))


def _gram(w: Column, i: Column) -> Column:
    return F.xxhash64(*[F.get(w, i + j) for j in range(K)])


def template_positions(docs: DataFrame, templates: Sequence[Template]) -> DataFrame:
    """(gram, template, label, base, size, at, said): a row for each k-gram of each template."""
    rows = [(n, t.label, t.base, len(t.text.split()), i, t.text.split()[i : i + K]) for n, t in enumerate(templates) for i in range(len(t.text.split()) - K + 1)]
    table = docs.sparkSession.createDataFrame(rows, "template int, label string, base boolean, size int, at int, said array<string>")
    return table.withColumn("gram", _gram(F.col("said"), F.lit(0)))


def scan(docs: DataFrame, key: Sequence[str] = ("doc_id",), templates: Sequence[Template] = TEMPLATES) -> DataFrame:
    """A row for each document and merged span, and one without a span for documents that have none.

    Columns: _row, key columns, n_words, template, label, base, start (first
    word of the template's place), span_score, exact (list of the word
    positions at which the template stands word for word).
    """
    grams = template_positions(docs, templates)
    positions = sum(max(0, len(t.text.split()) - K + 1) for t in templates)
    known = [r["gram"] for r in grams.select("gram").distinct().limit(LITERALS + 1).collect()]

    def found(w: Column) -> Column:
        spots = F.sequence(F.lit(0), F.size(w) - K)
        if len(known) <= LITERALS:
            spots = F.filter(spots, lambda i: _gram(w, i).isin(known))
        spots = F.when(F.size(w) >= K, spots).otherwise(F.array().cast("array<int>"))
        return F.struct(F.size(w).cast("long").alias("n"), F.transform(spots, lambda i: F.struct(i.alias("pos"), _gram(w, i).alias("gram"), F.slice(w, i + 1, K).alias("said"))).alias("hits"))

    # the words are bound to one name, so that they are made once for a text
    read = docs.select(F.monotonically_increasing_id().alias("_row"), *key, F.transform(F.array(words(F.col("text"))), found)[0].alias("_f"))
    hits = read.select("_row", *key, F.col("_f.n").alias("n_words"), F.explode_outer("_f.hits").alias("_hit"))
    near = grams.withColumnRenamed("said", "_template_said")
    near = F.broadcast(near) if positions <= POSITIONS else near
    votes = hits.join(near, (F.col("_hit.gram") == F.col("gram")) & (F.col("_hit.said") == F.col("_template_said")), "left")
    votes = votes.select("_row", *key, "n_words", "template", "label", "base", "size", "at", (F.col("_hit.pos") - F.col("at")).alias("diagonal"))
    row = ["_row", *key, "n_words"]
    what = ["template", "label", "base", "size"]
    diagonals = votes.repartition("_row").groupBy(*row, *what, "diagonal").agg(F.collect_set("at").alias("ats"))
    order = Window.partitionBy("_row", "template").orderBy("diagonal")
    apart = F.when(F.col("diagonal") - F.lag("diagonal").over(order) <= GAP, 0).otherwise(1)
    spans = diagonals.withColumn("_new", apart).withColumn("_span", F.sum("_new").over(order)).groupBy(*row, *what, "_span")
    covered = F.size(F.array_distinct(F.flatten(F.transform(F.flatten(F.collect_list("ats")), lambda t: F.sequence(t, t + K - 1)))))
    exact = F.array_sort(F.collect_list(F.when(F.size("ats") == F.col("size") - K + 1, F.col("diagonal"))))
    return spans.agg(F.min("diagonal").alias("start"), F.round(covered / F.col("size"), 6).alias("span_score"), exact.alias("exact")).drop("_span", "size")


def digest(docs: DataFrame, templates: Sequence[Template] = TEMPLATES) -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score) of every document."""
    spans = scan(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), ("doc_id",), templates)
    base = F.when(F.col("base"), F.col("exact"))
    listed = lambda keep: F.array_join(F.array_sort(F.collect_set(F.when(keep, F.col("label")))), ",")
    out = spans.groupBy("_row", "doc_id", "n_words").agg(
        F.sum(F.coalesce(F.size(base), F.lit(0))).cast("long").alias("n_base"),
        F.min(F.array_min(base)).cast("long").alias("first_word"),
        F.max(F.array_max(base)).cast("long").alias("last_word"),
        listed(F.col("base") & (F.size("exact") > 0)).alias("base_labels"),
        listed(F.col("span_score") >= COVER).alias("labels"),
        F.coalesce(F.max("span_score"), F.lit(0.0)).alias("score"),
    )
    return out.drop("_row")


def oracle(templates: Sequence[Template] = TEMPLATES) -> str:
    """DuckDB SQL for the rows of ``digest``."""
    rows = ", ".join(f"({n}, '{t.label}', {t.base}, {len(t.text.split())}, {i}, '{' '.join(t.text.split()[i : i + K])}')" for n, t in enumerate(templates) for i in range(len(t.text.split()) - K + 1))
    return f"""
WITH grams(template, label, base, size, spot, gram) AS (VALUES {rows}),
docs AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{WORD}') AS w FROM documents),
spots AS (SELECT r, w, unnest(range(1, len(w) - {K} + 2)) AS p FROM docs),
hits AS (SELECT r, p - 1 AS pos, w[p] || ' ' || w[p + 1] || ' ' || w[p + 2] AS gram FROM spots),
votes AS (SELECT r, template, label, base, size, pos - spot AS diagonal, list(DISTINCT spot) AS ats FROM hits JOIN grams USING (gram) GROUP BY ALL),
parted AS (SELECT *, sum(fresh) OVER (PARTITION BY r, template ORDER BY diagonal) AS span FROM (
  SELECT *, CASE WHEN diagonal - lag(diagonal) OVER (PARTITION BY r, template ORDER BY diagonal) <= {GAP} THEN 0 ELSE 1 END AS fresh FROM votes)),
lists AS (SELECT r, template, label, size, span, flatten(list(ats)) AS ats FROM parted GROUP BY r, template, label, size, span),
spans AS (SELECT r, label, len(list_distinct(flatten(list_transform(ats, lambda t: range(t, t + {K}))))) / size AS cover FROM lists),
best AS (SELECT r, string_agg(DISTINCT label, ',' ORDER BY label) FILTER (WHERE round(cover, 6) >= {COVER}) AS labels, max(round(cover, 6)) AS score FROM spans GROUP BY r),
exact AS (SELECT r, count(*) AS n, min(diagonal) AS f, max(diagonal) AS l, string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM votes WHERE base AND len(ats) = size - {K} + 1 GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_base, f::BIGINT AS first_word, l::BIGINT AS last_word,
  coalesce(exact.labels, '') AS base_labels, coalesce(best.labels, '') AS labels, coalesce(score, 0)::DOUBLE AS score
FROM docs LEFT JOIN best USING (r) LEFT JOIN exact USING (r)
"""
