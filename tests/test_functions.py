"""Rules of the column functions on literal rows: missing values, ties, division by zero, odd texts."""

from __future__ import annotations

import hashlib
import hmac

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from assayframe.functions import chemistry, dates, hashing, nested, normalize, numbers, text
from assayframe.operators import columns, dedupe, joins, models, reshape, statistics


def one(df, *cols):
    return tuple(df.select(*cols).first())


def test_row_sums_and_ratio(rows):
    df = rows([(None, None, 0.0)], "a double, b double, z double")
    a, b, z = F.col("a"), F.col("b"), F.col("z")
    assert one(df, numbers.row_sum([a, b]), numbers.row_sum([a, b], 1), numbers.safe_ratio(F.lit(1), z), numbers.safe_ratio(F.lit("x"), F.lit(2))) == (0.0, None, None, None)
    assert one(df, numbers.round_even(F.lit(0.125), 2), numbers.number(F.lit("nan")), numbers.row_argmax({"a": a, "b": b})) == (0.12, None, None)
    assert one(df, numbers.row_argmax({"x": F.lit(2), "y": F.lit(2)}), numbers.first_digit(F.lit(0.5)), numbers.counting_method(F.lit(20.0)), numbers.counting_method(a)) == ("x", 0, "plating", None)


def test_hashes(rows):
    df = rows([("Kush Co", None)], "p string, n string")
    want = hmac.new(b"key", b"kush_co", hashlib.sha256).hexdigest()
    assert one(df, hashing.sample_id("key", F.col("p")))[0] == want
    assert one(df, hashing.record_id([F.col("p"), F.col("n")]))[0] == hashlib.sha256(b"Kush Co").hexdigest()[:16]
    json = b'{"a": "Kush Co", "b": null}'
    assert one(df, hashing.fields_hash({"b": F.col("n"), "a": F.col("p")}))[0] == hashlib.sha256(json).hexdigest()


def test_golden_record(rows):
    """A plausible sample is valid; an impossible one without a state has two errors; spellings are normal."""
    df = normalize.validate(rows([("ca", 24.5), (None, 150.0)], "state string, total_thc double"))
    assert df.collect()[1].errors == ["Missing required field: state", "total_thc above maximum: 150.0 > 45"]
    assert [(r.is_valid, len(r.errors)) for r in df.collect()] == [(True, 0), (False, 2)]
    assert one(df, normalize.status(F.lit("PASSED")), normalize.product_type(F.lit("Pre-Roll")), normalize.status(F.lit(""))) == ("pass", "preroll", "nt")
    assert one(df, normalize.analyte_key(F.lit("CBD-A")), normalize.analyte_key(F.lit("CBD-A"), strict=True)) == ("cbda", "cbd_a")


def test_text(rows):
    df = rows([(1,)], "i int")
    assert one(df, *text.test_parts(F.lit("Total THC (mg/g) Raw Flower")).values()) == ("Total THC", "mg/g", "Raw Flower")
    assert one(df, *text.test_parts(F.lit("nothing here")).values()) == (None, None, None)
    assert one(df, text.longest_suffix(F.lit("Yeast Shake Trim"), ["Trim", "Shake Trim"]), text.bracket_type(F.lit("Mold")), text.bracket_type(F.lit("Mold (CFU/g) R&D Testing Buds"))) == ("Shake Trim", "R&D Testing", "Buds")
    assert one(df, text.strain_of_product(F.lit("Blue Dream - 3.5g | x")), text.label_name(F.lit("Blue Dream jar"), F.lit("blue dream")), text.label_name(F.lit(""), F.lit("OG"))) == ("Blue Dream", "Blue Dream jar", "OG")
    assert one(df, text.title(F.lit(""), F.lit("OG"), [F.lit("id")]), text.title(F.lit(None), F.lit(None), [F.lit("id")])) == ("OG", "id")
    assert one(df, text.ngrams(text.words(F.lit("The blue dream")), 2, ["the"]))[0] == ["blue dream"]
    assert one(df, text.ngrams(text.words(F.lit("one")), 2))[0] == []
    assert one(df, F.round(text.weight_grams(F.lit("1/8 oz")), 4), text.weight_grams(F.lit("(3.5g)")), text.money(F.lit("$1,234.50"))) == (3.5438, 3.5, 1234.5)
    assert one(df, *text.address_parts(F.lit("1 Main St, New Haven CT 06510")).values()) == ("1 Main St", "New Haven", "CT", "06510")
    assert one(df, text.unwrapped_url(F.lit("https://a.b/?q=https://c.d/e")), text.url_name(F.lit("https://a.b/c/d.pdf?x=1"))) == ("https://c.d/e", "d.pdf")
    assert one(df, *text.status_word(F.lit("Not Detected PASS")).values()) == ("ND", "pass")


def test_chemistry(rows):
    df = rows([(None, None, 10.0)], "delta_9_thc double, thca double, cbd double")
    out = chemistry.analyte_stats(df, ["delta_9_thc", "thca"], [])
    assert one(out, "total_cannabinoids", "total_thc", "total_terpenes", "total_cbd") == (None, 0.0, None, 10.0)
    assert one(df, *[chemistry.ratio_class(F.lit(x)) for x in (0.1, 10.0, 1.0, 0.0)]) == ("CBD Dominant", "THC Dominant", "Balanced THC:CBD", None)
    assert one(df, chemistry.shannon([F.lit(1.0), F.lit(1.0), F.lit(0.0)]), chemistry.shannon([F.lit(0.0)])) == (1.0, None)
    assert one(chemistry.milligrams_to_percent(rows([(50.0, 1.0)], "`CBD (mg/g; cannot fail)` double, x double")), "CBD", "x") == (5.0, 1.0)
    assert one(df, chemistry.decoded_value(F.lit("<LOQ mg")), chemistry.decoded_value(F.lit("1.5 mg/g")), chemistry.decoded_value(F.lit("?"))) == (0.0, 1.5, None)


def test_dates(rows):
    df = rows([(1,)], "i int")
    assert one(df, *[dates.parsed(F.lit(x)).cast("string") for x in ("2024-01-05", "1/5/2024", "soon")]) == ("2024-01-05 00:00:00", "2024-01-05 00:00:00", None)
    assert one(df, dates.week_label(F.lit("2024-01-03").cast("date")), dates.week_label(F.lit(None).cast("date")), dates.iso_text(F.lit("soon")), dates.short_year(F.lit("01/05/24"))) == ("2024-01-01/2024-01-07", None, "soon", "2024-01-05")
    filled = dates.fill_months(rows([("2024-01-01", 1), ("2024-03-01", 2)], "m string, n int").withColumn("m", F.col("m").cast("date")), "m", "n")
    assert [r.n for r in filled.orderBy("m").collect()] == [1, 0, 2]


def test_nested(rows):
    df = rows([("[{'analysis': 'potency', 'key': 'thca', 'value': '10'}, {'analysis': 'potency', 'key': 'thc', 'value': 'ND'}]",)], "r string")
    parsed = df.withColumn("r", nested.results_of(F.col("r")))
    assert one(nested.widened(parsed, "r", ["thca", "thc", "cbd"]), "thca", "thc", "cbd") == (10.0, None, None)
    assert one(parsed, nested.detected(F.col("r"), "potency"), F.round(nested.active_total(F.col("r"), "potency", "thc"), 3), nested.analyses_of(F.col("r"))) == (["thca"], 8.77, ["potency"])
    m = nested.methods(rows([(None, "HPLC", "")], "methods string, potency_method string, other_method string"))
    assert m.columns == ["methods"] and [tuple(x) for x in m.first()[0]] == [("potency", "HPLC")]
    ids = nested.traceability_ids(rows([("b", "a", None)], "metrc_1 string, metrc_2 string, batch string"), "metrc", ["batch"], keep=["batch"])
    assert one(ids, "traceability_ids", "batch") == (["a", "b"], None)


def test_columns(rows):
    df = rows([(None, "2", "x")], "`Total THC` double, totalThc string, k string")
    assert columns.renamed(df).columns == ["total_thc", "k"]
    assert one(columns.numeric(columns.renamed(df), ["k"]), "total_thc") == (2.0,)
    assert columns.ordered(rows([(1, 2, 3)], "z int, a int, k int"), ["k"]).columns == ["k", "a", "z"]
    assert one(columns.published(rows([(float("nan"), "")], "d double, s string")), "d", "s") == (None, None)
    assert columns.combine_redundant(rows([(None, 1.0)], "`THC (%) Buds` double, `THC (mg/g) Raw Buds` double"), ["Buds", "Raw Buds"]).first().asDict() == {"THC": 1.0}


def test_pivot_takes_first_that_is_there(rows):
    df = rows([("a", "t", None, 1), ("a", "t", 5.0, 2), ("a", "t", 6.0, 3), (None, "t", 1.0, 1)], "k string, test string, v double, o int")
    assert [tuple(r) for r in reshape.pivot_first(df, ["k"], "test", "v", ["o"], ["t", "u"]).collect()] == [("a", 5.0, None)]


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 3)), st.integers(0, 5)), max_size=20))
def test_dedupe_and_membership(spark, data):
    """De-duplication twice is de-duplication once; anti and semi parts make the whole; missing equals missing."""
    df = spark.createDataFrame([(k, o, i) for i, (k, o) in enumerate(data)], "k int, o int, i int")
    order = [F.col("o"), F.col("i")]
    first = dedupe.keep_first(df, ["k"], order)
    assert sorted(map(str, dedupe.keep_first(first, ["k"], order).collect())) == sorted(map(str, first.collect()))
    assert first.count() == len({k for k, _ in data})
    done = spark.createDataFrame([(1,), (None,)], "k int")
    assert joins.not_in(df, done, "k").count() == sum(k not in (1, None) for k, _ in data)


def test_joins(rows):
    import pytest

    left, right = rows([(1,), (2,), (None,)], "k int"), rows([(1, "a"), (1, "b")], "k int, v string")
    with pytest.raises(ValueError):
        joins.many_to_one(left, right, ["k"])
    assert sorted((r.k or 0, r.v) for r in joins.lookup(left, right, "k", ["v"], [F.col("v")]).collect()) == [(0, None), (1, "a"), (2, None)]
    assert one(left, joins.longest_contained(F.lit("blue dream haze"), ["blue", "blue dream", "haze"])) == ("blue dream",)


def test_statistics(rows):
    df = rows([("l", "p", 2020), ("l", "q", 2020), ("l", "p", 2022), ("l", "r", 2022), ("l", None, 2023)], "lab string, producer string, year int")
    got = {r.year: (r.total, r.returning, r.new) for r in statistics.new_and_returning(df, ["lab"], "producer", "year").collect()}
    assert got == {2020: (2, 0, 2), 2022: (2, 1, 1)}
    assert {r.year: r.retained for r in statistics.retention(df, ["lab"], "producer", "year").collect()} == {2022: 0, 2023: 0}
    shares = statistics.distribution(df, ["lab"], "producer").collect()
    assert sum(r.percent for r in shares) == 80.0
    counts = statistics.rate(df, ["lab"], F.col("producer") == "p")
    assert one(counts, "n", "rate") == (5, 40.0) and one(statistics.rate(df, ["lab"], F.col("producer") == "p", tested_only=True), "rate") == (50.0,)


def test_models(rows):
    df = rows([("a", 1.0), ("a", 2.0), ("b", 3.0), ("b", 5.0)], "g string, v double")
    t = models.t_test(df, "g", "a", "b", "v").first()
    assert round(t.t, 6) == -2.236068 and t.freedom == 2.0
    assert round(models.anova(df, "g", "v").first().f, 6) == 5.0
    assert models.origin_slope(rows([("a", 1.0, 2.0), ("a", 2.0, 4.0)], "g string, x double, y double"), ["g"], "x", "y").first().slope == 2.0
