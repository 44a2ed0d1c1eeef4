"""Mixing sources to target weights by iterative proportional fitting, in DataFrame operations only.

Documents are counted into cells (source, language, topic).  The cells' token
weights are raked: scaled by each dimension's targets in turn until every
marginal of the weights meets its target.  A document of a cell is kept with
the probability rate * weight / tokens of its cell, so expected tokens have
the target marginals; by default the rate is the largest at which no
probability passes 1.  With ``at_most`` the rate is lowered where more than that
share of all tokens would be kept; the marginals are still met.  With
``keep_share`` a share of all tokens is asked for; where that
takes probabilities above 1 they are cut, and the rate of the other cells is
raised so that the expected sum is still met, but the marginals are not.

Targets are shares of tokens, as a table or by flattening: a value's share of
all tokens to a power below 1.  Cells are as many as there are combinations;
they are a table throughout, broadcast to the documents only after their
number has been checked, or with only the most frequent ones beyond a bound.  Targets of several dimensions may contradict each
other (a language of one source only): ``marginals`` tells what each value's
goal was and what it got, and ``rake`` warns, or raises an error if asked to,
where a marginal is off by more than ``TOLERANCE``.

A document's topic is the one whose marks it holds most often, the first of
equal ones, if there is a mark for every ``TOPIC_TOKENS`` tokens; else prose.

Sampling compares a hash of doc_id and text with the unrounded probability, so
it is the same for every run and partitioning.

Defined cases: null source, language or topic counts as the empty string;
null or empty text has 0 tokens, and documents of cells without tokens get
the probability 0; rows that repeat a doc_id and its text share their fate within a cell, and so
do equal texts without a doc_id;
targets of values that don't occur are left out and the rest scaled up;
values without a target have weight 0; an empty table stays empty; ``sample``
keeps all columns of the input as they are, ``calibrated`` replaces those with
the names of the ones it adds.
"""

from __future__ import annotations

import warnings
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .shared import looked_up, private, written

DIMENSIONS = ("source", "lang", "topic")
#: Marks of each topic, as they stand in the text.
TOPICS: Sequence[tuple[str, Sequence[str]]] = (
    ("legal", ("icense", "ICENSE", "opyright", "OPYRIGHT", "arranty", "WARRANTY", "iability", "ermission")),
    ("contact", ("@", "://", "+1 (", "+49", "+33", "+34")),
    ("table", (" | ", "|\n", "\t")),
    ("code", (' = "', "def ", "return ", "import ", "{", "};", "();")),
)
#: Tokens for each of which a topic needs one mark.
TOPIC_TOKENS = 200
#: Largest gap of a marginal that counts as met.
TOLERANCE = 1e-6
OTHER_TOPIC = "prose"
#: Cells up to which they are broadcast: five short columns each, some 10 MB.
BROADCAST_CELLS = 100_000


@dataclass(frozen=True)
class Target:
    """Target shares of one dimension: given ones, or token shares to the power ``flatten``."""

    flatten: float | None = None
    shares: Mapping[str, float] | None = None


TARGETS: Mapping[str, Target] = {
    "source": Target(flatten=0.7),
    "lang": Target(flatten=0.8),
    "topic": Target(flatten=0.9),
}


def topic(text: Column, n: Column, topics: Sequence[tuple[str, Sequence[str]]] = TOPICS) -> Column:
    """Topic of a text of n tokens; a mark is counted by what is left without it."""
    times = lambda mark: F.floor((F.octet_length(text) - F.octet_length(F.replace(text, F.lit(mark), F.lit("")))) / len(mark.encode()))
    counted = F.array(*[sum((times(m) for m in marks[1:]), times(marks[0])) for _, marks in topics])

    def judged(counts: Column) -> Column:
        most = F.array_max(counts)
        first = F.array_position(counts, most).cast("int")
        name = F.element_at(F.array(*[F.lit(name) for name, _ in topics]), first)
        return F.when(most * TOPIC_TOKENS >= F.greatest(n, F.lit(1)), name).otherwise(OTHER_TOPIC)

    # the counts are bound to a name, so that they are made once
    return F.transform(F.array(counted), judged)[0]


def tokens(text: Column) -> Column:
    """Words between white space."""
    return F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def featured(docs: DataFrame, out: str, topics: Sequence[tuple[str, Sequence[str]]] = TOPICS) -> DataFrame:
    """docs with a struct column of source, lang, topic, tokens and a hash of the text, of which the draw is made."""
    text = F.coalesce(F.col("text"), F.lit(""))
    plain = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    draw = F.md5(text.cast("binary")).alias("draw")
    made = F.transform(F.array(tokens(text)), lambda n: F.struct(plain("source").alias("source"), plain("lang").alias("lang"), topic(text, n, topics).alias("topic"), n.alias("tokens"), draw))[0]
    return docs.withColumn(out, made)


def _goals(cells: DataFrame, targets: Mapping[str, Target]) -> DataFrame:
    """cells with one column of target shares for each dimension, of the values that occur."""
    for name in DIMENSIONS:
        goal = targets[name]
        values = cells.groupBy(name).agg(F.sum("tokens").alias("_t")).where("_t > 0")
        if goal.shares is not None:
            given = cells.sparkSession.createDataFrame([(k, float(v)) for k, v in goal.shares.items()], f"{name} string, _goal double")
            values = values.join(given, name).drop("_t")
        else:
            values = values.select(name, F.pow(F.col("_t").cast("double"), F.lit(goal.flatten)).alias("_goal"))
        whole = values.agg(F.sum("_goal").alias("all")).first()["all"] or 1.0
        values = values.select(name, (F.col("_goal") / F.lit(whole)).alias(f"goal_{name}"))
        cells = cells.join(values, name, "left")
    return cells.fillna(0.0, [f"goal_{name}" for name in DIMENSIONS])


def marginals(raked: DataFrame) -> DataFrame:
    """(dimension, value, goal, got, gap) of every value that occurs; got is its share of the raked weights."""
    parts = [raked.groupBy(F.lit(n).alias("dimension"), F.col(n).alias("value")).agg(F.max(f"goal_{n}").alias("goal"), F.sum("weight").alias("got"), F.sum("tokens").alias("_t")).where("_t > 0").drop("_t") for n in DIMENSIONS]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out.withColumn("gap", F.col("got") - F.col("goal"))


def rake(cells: DataFrame, targets: Mapping[str, Target] = TARGETS, sweeps: int = 4, most: int = 10, close: float = 1e-13, strict: bool = False) -> DataFrame:
    """Cells (source, lang, topic, tokens) with ``weight``: raked shares of tokens, and the goals.

    ``sweeps`` rounds over the dimensions are one job; jobs are repeated until
    no marginal is off by more than ``close``, at most ``most`` times.  If one
    is off by more than ``TOLERANCE`` then, there is a warning that names it,
    or an error (``strict``).
    """
    raked = written(_goals(cells, targets).withColumn("weight", F.when(F.greatest(F.col("tokens"), F.lit(0)) > 0, F.col("tokens").cast("double")).otherwise(0.0)), "cells")
    worst, few = None, raked.count() <= BROADCAST_CELLS
    for _ in range(most):
        # what one task holds easily needs no shuffle for each dimension
        out = raked.coalesce(1) if few else raked
        for _ in range(sweeps):
            for name in DIMENSIONS:
                whole = F.sum("weight").over(Window.partitionBy(name))
                out = out.withColumn("_whole", whole).withColumn("weight", F.when(F.col("_whole") > 0, F.col("weight") * F.col(f"goal_{name}") / F.col("_whole")).otherwise(0.0)).drop("_whole")
        raked = written(out, "cells")
        worst = marginals(raked).agg(F.max_by(F.struct("dimension", "value", "goal", "got", "gap"), F.abs("gap")).alias("w")).first()["w"]
        if worst is None or abs(worst["gap"]) <= close:
            break
    if worst is not None and abs(worst["gap"]) > TOLERANCE:
        said = f"mixing targets are not met: {worst['dimension']} {worst['value']!r} gets {worst['got']:.6f} for {worst['goal']:.6f}"
        if strict:
            raise ValueError(said)
        warnings.warn(said, stacklevel=2)
    return raked


def probabilities(cells: DataFrame, keep_share: float | None = None, at_most: float | None = None) -> DataFrame:
    """Raked cells with ``probability``, so that expected tokens are in proportion to the weights."""
    ratio = F.col("weight") / F.col("tokens")
    live = cells.where("tokens > 0 and weight > 0")
    top = live.agg(F.max(ratio).alias("top")).first()["top"]
    if top is None:
        return cells.withColumn("probability", F.lit(0.0))
    rate = 1.0 / top
    if at_most is not None:
        whole = cells.agg(F.sum("tokens").alias("t")).first()["t"]
        rate = min(rate, at_most * whole / live.agg(F.sum("weight").alias("w")).first()["w"])
    if keep_share is not None:
        target_tokens = keep_share * cells.agg(F.sum("tokens").alias("t")).first()["t"]
        rate = target_tokens / (live.agg(F.sum("weight").alias("w")).first()["w"])
        while True:  # each step cuts at least one more cell at 1, or is the last
            full = F.lit(rate) * ratio >= 1
            row = live.agg(F.sum(F.when(full, F.col("tokens")).otherwise(0)).alias("cut"), F.sum(F.when(full, 0.0).otherwise(F.col("weight"))).alias("open")).first()
            if not row["open"] or row["cut"] >= target_tokens:
                break
            raised = (target_tokens - row["cut"]) / row["open"]
            if raised <= rate * (1 + 1e-12):
                break
            rate = raised
    return cells.withColumn("probability", F.when(F.col("tokens") > 0, F.least(F.lit(1.0), F.lit(rate) * ratio)).otherwise(0.0))


def _decided(base: DataFrame, at: str, targets: Mapping[str, Target], keep_share: float | None, seed: int, at_most: float | None, strict: bool, probability: str, sampled: str) -> DataFrame:
    """base, a written table with the features in the struct ``at``, with the columns probability and sampled."""
    keys = ("source", "lang", "topic")
    cells = base.groupBy(*[F.col(f"{at}.{k}").alias(k) for k in keys]).agg(F.sum(f"{at}.tokens").alias("tokens"))
    rates = written(probabilities(rake(cells, targets, strict=strict), keep_share, at_most).select(*keys, F.col("probability").alias(probability)), "rates")
    (cell,) = private(base, "cell")
    rates = rates.select(F.struct(*keys).alias(cell), probability)
    joined = looked_up(base.withColumn(cell, F.struct(*[F.col(f"{at}.{k}").alias(k) for k in keys])), cell, rates).drop(cell).withColumn(probability, F.coalesce(probability, F.lit(0.0)))
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.col(f"{at}.draw"))
    chance = F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("double") / F.lit(float(1 << 32))
    return joined.withColumn(sampled, chance < F.col(probability))


ADDED = ("_source", "_lang", "_topic", "_tokens", "probability", "sampled")


def calibrated(docs: DataFrame, targets: Mapping[str, Target] = TARGETS, keep_share: float | None = None, seed: int = 0, at_most: float | None = None, strict: bool = False) -> DataFrame:
    """docs with _source, _lang, _topic, _tokens, probability and sampled; all rows stay."""
    own = [c for c in docs.columns if c.lower() not in ADDED]
    at, probability, sampled = private(docs, "mix", "probability", "sampled")
    out = _decided(written(featured(docs.select(*own), at), "features"), at, targets, keep_share, seed, at_most, strict, probability, sampled)
    return out.select(*own, *[F.col(f"{at}.{k}").alias(f"_{k}") for k in ("source", "lang", "topic", "tokens")], F.col(probability).alias("probability"), F.col(sampled).alias("sampled"))


def digest(docs: DataFrame, targets: Mapping[str, Target] = TARGETS, seed: int = 0) -> DataFrame:
    """(doc_id, source, lang, topic, tokens, probability, sampled) of every document.

    The text is read once: what is counted of it is kept, and joined to the raked cells.
    """
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "source", "lang", "text")
    out = _decided(written(featured(narrow, "mix").select("doc_id", "mix"), "features"), "mix", targets, None, seed, None, False, "probability", "sampled")
    return out.select("doc_id", "mix.source", "mix.lang", "mix.topic", "mix.tokens", F.round("probability", 5).alias("probability"), "sampled")


def sample(docs: DataFrame, targets: Mapping[str, Target] = TARGETS, keep_share: float | None = None, seed: int = 0, at_most: float | None = None, strict: bool = False) -> DataFrame:
    """The documents that are sampled, with their own columns."""
    at, probability, sampled = private(docs, "mix", "probability", "sampled")
    out = _decided(written(featured(docs, at), "features"), at, targets, keep_share, seed, at_most, strict, probability, sampled)
    return out.where(F.col(sampled)).select(*docs.columns)


def oracle(targets: Mapping[str, Target] = TARGETS, topics: Sequence[tuple[str, Sequence[str]]] = TOPICS, sweeps: int = 40, seed: int = 0) -> str:
    """DuckDB SQL for the rows of ``digest``: the sweeps written out one after another."""
    quoted = lambda x: "'" + x.replace("'", "''") + "'"
    times = lambda mark: f"(strlen(t) - strlen(replace(t, {quoted(mark)}, ''))) // {len(mark.encode())}"
    counts = ", ".join(f"{' + '.join(map(times, marks))} AS n_{name}" for name, marks in topics)
    most = f"greatest({', '.join(f'n_{name}' for name, _ in topics)})"
    kinds = " ".join(f"WHEN {most} = n_{name} THEN {quoted(name)}" for name, _ in topics)
    parts = [
        f"""raw AS (SELECT doc_id, coalesce(source, '') AS source, coalesce(lang, '') AS lang, coalesce(text, '') AS t FROM documents)""",
        f"""counted AS (SELECT doc_id, source, lang, len(regexp_extract_all(t, '[^\x20\x09-\x0D]+'))::BIGINT AS tokens, t, {counts} FROM raw)""",
        f"""docs AS (SELECT doc_id, source, lang, CASE WHEN {most} * {TOPIC_TOKENS} < greatest(tokens, 1) THEN '{OTHER_TOPIC}' {kinds} END AS topic, tokens, t FROM counted)""",
        "cells AS (SELECT source, lang, topic, sum(tokens)::DOUBLE AS tokens FROM docs GROUP BY ALL)",
    ]
    for name in DIMENSIONS:
        goal = targets[name]
        shares = f"pow(sum(tokens), {goal.flatten})" if goal.shares is None else f"CASE {name} " + " ".join(f"WHEN {quoted(k)} THEN {v!r}" for k, v in goal.shares.items()) + " END"
        parts.append(f"raw_{name} AS (SELECT {name}, {shares} AS g FROM cells GROUP BY {name} HAVING sum(tokens) > 0), goal_{name} AS (SELECT {name}, g / (SELECT sum(g) FROM raw_{name}) AS g FROM raw_{name} WHERE g IS NOT NULL)")
    goals = ", ".join(f"coalesce(goal_{n}.g, 0) AS g_{n}" for n in DIMENSIONS)
    parts.append(f"w0 AS MATERIALIZED (SELECT cells.*, {goals}, tokens AS w FROM cells " + " ".join(f"LEFT JOIN goal_{n} USING ({n})" for n in DIMENSIONS) + ")")
    step = 0
    for _ in range(sweeps):
        for n in DIMENSIONS:
            parts.append(f"w{step + 1} AS MATERIALIZED (SELECT * EXCLUDE (w), CASE WHEN sum(w) OVER (PARTITION BY {n}) > 0 THEN w * g_{n} / sum(w) OVER (PARTITION BY {n}) ELSE 0 END AS w FROM w{step})")
            step += 1
    parts.append(f"rates AS (SELECT source, lang, topic, CASE WHEN tokens > 0 THEN (w / tokens) / (SELECT max(w / tokens) FROM w{step} WHERE tokens > 0) ELSE 0 END AS p FROM w{step})")
    return "WITH " + ",\n".join(parts) + f"""
SELECT doc_id, source, lang, topic, tokens, round(p, 5) AS probability, ('0x' || substr(md5('{seed}:' || coalesce(doc_id::VARCHAR, '') || ':' || md5(t)), 1, 8))::UBIGINT / 4294967296.0 < p AS sampled
FROM docs JOIN rates USING (source, lang, topic)"""
