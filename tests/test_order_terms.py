"""Whole-table order, many terms, runs of a table that end early, nearest vectors, long literals."""

from __future__ import annotations

import json
import math
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from assayframe.functions import nested
from assayframe.operators import joins, order, terms, vectors
from assayframe.sources import runs, sinks


@pytest.fixture(scope="module")
def series(spark):
    return spark.range(800).select("id", (F.xxhash64("id") % 37).alias("k"), F.when(F.col("id") % 7 > 0, F.col("id") * 1.5).alias("v")).cache()


@pytest.mark.parametrize("parts", [None, 1, 3, 200])
def test_whole_order(series, parts):
    """Ranges that are smaller than a moving frame, and a single one."""
    by = [F.col("k"), F.col("id")]
    want = {r.id: r for r in series.select("*", F.row_number().over(Window.orderBy(*by)).alias("place"), F.avg("v").over(Window.orderBy(*by).rowsBetween(-29, 0)).alias("m")).collect()}
    placed = order.numbered(series, by, parts=parts).collect()
    assert len(placed) == 800 and all(want[r.id].place == r.place for r in placed)
    moved = order.moving(series, "v", by, 30, "m", parts=parts).collect()
    assert len(moved) == 800
    for r in moved:
        assert want[r.id].m is r.m is None or math.isclose(want[r.id].m, r.m)


def test_whole_ranks(series):
    want = {r.id: (r.r, r.d) for r in series.select("id", F.rank().over(Window.orderBy(F.desc("v"))).alias("r"), F.dense_rank().over(Window.orderBy(F.desc("v"))).alias("d")).collect()}
    assert {r.id: (r["rank"], r.dense_rank) for r in order.ranked(series, [F.desc("v")], ["v"], parts=5).collect()} == want


def test_whole_order_needs_no_single_task(series):
    plan = order.numbered(series, [F.col("id")])._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan


def test_whole_order_of_nothing(series):
    assert order.numbered(series.where("false"), [F.col("id")]).count() == 0
    assert order.moving(series.where("false"), "v", [F.col("id")]).count() == 0


def test_many_terms(spark):
    """Terms inside words, with blanks inside and at their ends, repeated, null and blank ones."""
    rng = random.Random(3)
    alphabet = ["a", "b", "ab", " ", "ba", "c d", "dd", "é", "  "]
    made = lambda most: "".join(rng.choice(alphabet) for _ in range(rng.randint(0, most)))
    texts = [None, "", " ", *[made(12) for _ in range(200)]]
    listed = [None, " ", *sorted({made(5) for _ in range(120)}), "ab"]
    table = spark.createDataFrame(list(enumerate(listed)), "pos int, term string")
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    for by, key in ((terms.longest_first("term") + [F.col("pos")], lambda x: (-len(x[1]), x[0])), ([F.col("pos")], lambda x: x[0])):
        got = {r.id: r.term for r in terms.with_best_term(df, "text", table, "term", by).collect()}
        for i, text in enumerate(texts):
            held = [x for x in enumerate(listed) if x[1] and x[1].strip() and text and x[1] in text]
            assert got[i] == (min(held, key=key)[1] if held else None)


@pytest.mark.parametrize(("few", "slice_"), [(20_000, 100_000), (0, 100_000), (0, 3)])
def test_terms_by_each_way(spark, monkeypatch, few, slice_):
    """In all tasks, by an index, and by an index whose common words and grams are dealt into slices: one result."""
    monkeypatch.setattr(terms, "FEW", few)
    monkeypatch.setattr(terms, "SLICE", slice_)
    monkeypatch.setattr(terms, "STRETCH", 16)
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abé") for _ in range(rng.choice([1, 2, 3, 5, 12])))
    texts = [None, "", *[" ".join(["for", *(word() for _ in range(rng.randint(0, 6)))]) for _ in range(150)]]
    listed = [None, " ", "for ", " a", *sorted({w[rng.randint(0, 2) :] for w in (word() for _ in range(60))} | {f"{word()} {word()}" for _ in range(60)})]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    table = spark.createDataFrame([(x,) for x in listed], "term string")
    got = {r.id: r.term for r in terms.with_best_term(df, "text", table, "term", terms.longest_first("term")).collect()}
    assert len(got) == len(texts)
    for i, text in enumerate(texts):
        held = [x for x in listed if x and x.strip() and text and x in text]
        assert got[i] == (min(held, key=lambda x: (-len(x), x.encode())) if held else None)


def test_few_terms_need_no_shuffle(spark):
    df = spark.createDataFrame([(1, "a b")], "id int, text string")
    plan = terms.with_best_term(df, "text", spark.createDataFrame([("b",)], "term string"), "term", terms.longest_first("term"))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_a_word_of_all_texts_is_no_single_task(spark, monkeypatch):
    """A word that all texts hold meets its terms in slices."""
    monkeypatch.setattr(terms, "SLICE", 50)
    said = spark.range(2000).select(F.col("id").alias("key"), F.lit("for").alias("word"))
    met = terms._met(said, spark.createDataFrame([("for", 1), ("no", 2)], "word string, rank int"), "word", said.groupBy("word").agg(F.count("*").alias("n")), "key")
    assert met.count() == met.select("key").distinct().count() == 2000
    plan = met._jdf.queryExecution().optimizedPlan().toString()
    assert "_slice" in plan.split("Join Inner")[1].splitlines()[0]


@pytest.mark.parametrize("most", [1_000_000, 0])
def test_shared_ngrams_by_their_words(spark, monkeypatch, most):
    """Looked up by their words or not: the n-grams that a plain count gives; few others are dealt out."""
    from assayframe.functions import text

    monkeypatch.setattr(joins, "SHARED_WORDS", most)
    rng = random.Random(6)
    data = [(rng.choice(["en", "de", "fr", None]), " ".join(rng.choice("abcdefgh") + rng.choice("xyz") for _ in range(rng.randint(0, 9)))) for _ in range(60)]
    df = spark.createDataFrame([*data, ("en", "only one"), ("de", None)], "lang string, text string")
    want: dict = {}
    for lang, said in data:
        words = said.split()
        for n in (1, 2, 3):
            for i in range(len(words) - n + 1):
                if "ax" not in words[i : i + n] and lang:
                    want.setdefault(" ".join(words[i : i + n]), set()).add(lang)
    got = joins.shared_ngrams_to(df, "lang", text.words(F.col("text")), 3, "en", ["ax"])
    assert sorted((r.gram, list(r.groups)) for r in got.collect()) == sorted((g, sorted(x)) for g, x in want.items() if len(x) > 1 and "en" in x)
    assert ("LeftSemi" in got._jdf.queryExecution().optimizedPlan().toString()) == (most > 0)


def test_known_terms_by_index(spark, monkeypatch):
    """The index gives what the branches give."""
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefg") for _ in range(rng.randint(1, 3)))
    known = sorted({word().upper() for _ in range(40)} | {f"{word()} {word()}" for _ in range(30)})
    df = spark.createDataFrame([(i, " ".join(word() for _ in range(3)), rng.choice([None, word().upper()])) for i in range(120)], "id int, a string, b string")
    run = lambda: sorted((r.id, r.strain) for r in joins.known_terms(df, ["a", "b"], known, {known[0]: "usual"}, "strain").collect())
    few = run()
    monkeypatch.setattr(joins, "FEW_TERMS", 3)
    assert few and run() == few


def _table(spark, path):
    df = sinks.read_documents(spark, path)
    return None if df is None else sorted((r.id, r.v) for r in df.collect())


def test_repeated_keys_are_stored_once(spark, tmp_path):
    path, ledger = str(tmp_path / "docs"), str(tmp_path / "done")
    docs = lambda *x: spark.createDataFrame(list(x), "id long, v long")
    sinks.upsert_documents(docs((1, 1), (1, 5), (1, 3), (2, 2)), path, ledger)
    assert _table(spark, path) == [(1, 5), (2, 2)]
    sinks.upsert_documents(docs((2, 8), (3, 1), (3, 2)), path, ledger, order=[-F.col("v")])
    assert _table(spark, path) == [(1, 5), (2, 2), (3, 1)]
    sinks.upsert_documents(docs((2, 8), (2, 9), (4, 4)), path, ledger, update=True)
    assert _table(spark, path) == [(1, 5), (2, 9), (3, 1), (4, 4)]
    runs.compact(spark, path, ["id"])
    assert len(runs.marked(spark, path)) == 1 and _table(spark, path) == [(1, 5), (2, 9), (3, 1), (4, 4)]
    assert runs.clear(spark, path) == 3 and _table(spark, path) == [(1, 5), (2, 9), (3, 1), (4, 4)]
    assert sorted(r.id for r in spark.read.parquet(ledger).collect()) == [1, 2, 3, 4]


@pytest.mark.parametrize("step", ["store", "mark", "ledger"])
def test_a_run_that_ends_early(spark, tmp_path, monkeypatch, step):
    """Before the mark nothing has changed; after it everything has; the same call makes it good."""
    path, ledger = str(tmp_path / "docs"), str(tmp_path / "done")
    docs = lambda *x: spark.createDataFrame(list(x), "id long, v long")
    sinks.upsert_documents(docs((1, 1), (2, 2)), path, ledger)
    stop = RuntimeError("lost")

    def fails(*_, **__):
        raise stop

    with monkeypatch.context() as m:
        if step == "ledger":
            real = sinks._unstored
            m.setattr(sinks, "_unstored", lambda rows, known, keys: fails() if rows.columns == ["id"] else real(rows, known, keys))
        else:
            m.setattr(runs, step, fails)
        with pytest.raises(RuntimeError):
            sinks.upsert_documents(docs((2, 7), (3, 3)), path, ledger, update=True)
    assert _table(spark, path) == ([(1, 1), (2, 7), (3, 3)] if step == "ledger" else [(1, 1), (2, 2)])
    sinks.upsert_documents(docs((2, 7), (3, 3)), path, ledger, update=True)
    assert _table(spark, path) == [(1, 1), (2, 7), (3, 3)]


def test_two_runs_at_once(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(3)
    runs.add_run(df, path)
    number = runs.next_number(spark, path)
    runs.mark(spark, path, runs.store(df, path), number)
    with pytest.raises(ValueError, match="meanwhile"):
        runs.mark(spark, path, runs.store(df, path), number)
    assert runs.read_runs(spark, path).count() == 6


def test_nearest_with_odd_vectors(spark):
    data = [(1, [1.0, 0.0]), (2, [0.9, 0.1]), (3, None), (4, [1.0]), (5, [0.0, 0.0]), (6, [float("nan"), 1.0]), (7, [1.0, None]), (8, [2.0, 0.0]), (None, [1.0, 0.0]), (9, [2.0])]
    df = spark.createDataFrame(data, "id long, v array<double>")
    got = sorted((r.q, r.id, r["rank"]) for r in vectors.nearest(df, df.where("id in (1, 3, 4, 6)"), "id", "v", 2).collect())
    assert got == [(1, 2, 2), (1, 8, 1), (4, 9, 1)]


def test_nearest_matches_plain_search(spark):
    rng = random.Random(9)
    data = [(i, [rng.randint(-2, 2) * 1.0 for _ in range(3)]) for i in range(150)]
    df = spark.createDataFrame(data, "id long, v array<double>")
    got = {(r.q, r["rank"]): r.id for r in vectors.nearest(df, df.where("id % 20 = 0"), "id", "v", 4).collect()}
    size = lambda v: math.sqrt(sum(x * x for x in v))
    for q, v in data[::20]:
        if size(v):
            near = sorted((-round(sum(x * y for x, y in zip(v, w, strict=True)) / size(v) / size(w), 6), i) for i, w in data if i != q and size(w))
            assert [got.get((q, n + 1)) for n in range(4)] == [i for _, i in near[:4]]


@pytest.mark.parametrize("value", [
    ["a'b", 'say "x"', None, True, "None, True", "back\\slash", "tab\t", "line\nend", "ünï", "\x07\x0b\x00", "\\x41", 'q\\"', "it's \"both\"", "\\", "\\d", ""],
    {"k": [1.5, -2, {"n": None}], "None": False},
    ["x" * 1_000_000, "'" * 50_000, "\\" * 30_000],
])
def test_literals(spark, value):
    """What Python prints of a value reads as the value."""
    said = spark.createDataFrame([(repr(value),)], "t string").select(nested.as_json(F.col("t")).alias("j")).first().j
    assert json.loads(said, strict=False) == value


def test_hexadecimal_escapes(spark):
    df = spark.createDataFrame([(r"['\x41\x42', '\\x41', '\xe9']",)], "t string")
    assert df.select(F.from_json(nested.as_json(F.col("t")), "array<string>")).first()[0] == ["AB", "\\x41", "é"]


def test_nearest_by_cells(spark, monkeypatch):
    """Every vector in a cell, hot cells in slices, recall against the exact search; all cells asked give the exact result."""
    rng = random.Random(14)
    middle = [[rng.gauss(0, 1) for _ in range(12)] for _ in range(15)]
    data = [(i, [x + rng.gauss(0, 0.4) for x in middle[0 if i % 3 == 0 else i % 15]]) for i in range(1500)]
    df = spark.createDataFrame([*data, (5000, None), (5001, [0.0] * 12), (5002, [1.0]), (None, middle[0])], "id long, v array<double>")
    asked = df.where("id % 20 = 0")
    exact = vectors.nearest(df.where("size(v) = 12"), asked, "id", "v", 5)
    monkeypatch.setattr(vectors, "SLICE", 100)
    some = vectors.nearest_by_cells(df, asked, "id", "v", 5, cells=20, probes=5, sample=500)
    assert vectors.recall(some, exact, "id").first().recall >= 0.9
    every = vectors.nearest_by_cells(df, asked, "id", "v", 5, cells=20, probes=20, sample=500)
    assert sorted(map(tuple, every.collect())) == sorted(map(tuple, exact.collect()))
    assert vectors.nearest_by_cells(df.where("false"), asked, "id", "v", 5).count() == 0


def test_nearest_by_cells_holds_bounded_lots(spark, monkeypatch):
    """However many queries and vectors a cell has, a task compares few of either at once, and the result is the exact one."""
    rng = random.Random(15)
    data = [(i, [float(i % 7 == 0) + rng.gauss(0, 1) for _ in range(4)]) for i in range(1200)]
    data += [(2000 + i, data[i][1]) for i in range(300)]  # equal vectors: ties by key
    df = spark.createDataFrame(data, "id long, v array<double>")
    monkeypatch.setattr(vectors, "SLICE", 150)
    monkeypatch.setattr(vectors, "LOT", 40)
    top, unit, places = vectors._top, vectors._unit, spark.sparkContext.accumulator(0)

    def few(names, grid, ids, own, k, digits):
        assert len(names) <= 40 and len(ids) <= 40
        return top(names, grid, ids, own, k, digits)

    def held(rows):
        assert len(rows) <= 250
        places.add(1)
        return unit(rows)

    monkeypatch.setattr(vectors, "_top", few)
    asked = df.where("id % 2 = 0")
    exact = sorted(map(tuple, vectors.nearest(df, asked, "id", "v", 3).collect()))
    monkeypatch.setattr(vectors, "_unit", held)
    found = vectors.nearest_by_cells(df, asked, "id", "v", 3, cells=2, probes=2, sample=100)
    assert sorted(map(tuple, found.collect())) == exact and len(exact) == 3 * asked.count() and places.value


def test_large_joins_in_tasks(spark, monkeypatch):
    """Rows as of a plain join, with missing and repeated keys on either side; a task holds few of them."""
    some, other = [(None if i % 50 == 0 else i % 600, i) for i in range(3000)], [(None, -1), *[(i % 500, i) for i in range(520)]]
    left, right = spark.createDataFrame(some, "k long, a long"), spark.createDataFrame(other, "k long, b long")
    plain = sorted(map(tuple, joins.in_tasks(left, right, "k").collect()))
    monkeypatch.setattr(joins, "FEW_ROWS", 100)
    monkeypatch.setattr(joins, "TASK_ROWS", 100)
    dealt = joins.in_tasks(left, right, "k")
    assert sorted(map(tuple, dealt.collect())) == plain == sorted((k, a, b) for k, a in some for j, b in other if k is not None and k == j)
    assert dealt.rdd.getNumPartitions() == 30


def test_samples_in_tasks(spark, monkeypatch):
    """The base of the statistics is joined in tasks of bounded rows, whatever it has."""
    from assayframe.plans import figures

    monkeypatch.setattr(joins, "FEW_ROWS", 1000, raising=False)
    monkeypatch.setattr(joins, "TASK_ROWS", 300, raising=False)
    rows = figures.samples(lambda name: spark.read.parquet(f"/root/testdata/sf0.001/{name}.parquet"))
    held = [r["count"] for r in rows.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(held) > 3000 and max(held) <= 600


def test_entity_growth_in_tasks(spark, monkeypatch):
    """Distinct values are counted over tasks of bounded rows, with the same result."""
    from assayframe.plans import registry

    growth = lambda: registry.QUERIES["entity_growth"](spark, "/root/testdata/sf0.001")
    plain = sorted(map(str, growth().collect()))
    monkeypatch.setattr(joins, "FEW_ROWS", 1000, raising=False)
    monkeypatch.setattr(joins, "TASK_ROWS", 300, raising=False)
    dealt = growth()
    assert dealt._jdf.queryExecution().toString().count("REPARTITION_BY_NUM") >= 2
    assert sorted(map(str, dealt.collect())) == plain
