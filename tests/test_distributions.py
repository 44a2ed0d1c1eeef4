"""p-values against closed forms, published tables and each other."""

from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import functions as F

from assayframe.functions import distributions as d
from assayframe.operators import models


def test_closed_forms():
    for x in (0.0, 0.1, 0.7, 1.0, 2.5, 9.0, 60.0):
        assert d.t_p(x, 1) == pytest.approx(1 - 2 * math.atan(x) / math.pi, abs=1e-12)
        assert d.t_p(-x, 2) == pytest.approx(1 - x / math.sqrt(2 + x * x), abs=1e-12)
        assert d.chi_square_p(x, 2) == pytest.approx(math.exp(-x / 2), abs=1e-12)
        assert d.chi_square_p(x, 8) == pytest.approx(math.exp(-x / 2) * sum((x / 2) ** i / math.factorial(i) for i in range(4)), abs=1e-12)
        for n in (3, 40, 5000):
            assert d.f_p(x, 2, n) == pytest.approx((1 + 2 * x / n) ** (-n / 2), abs=1e-10)
            assert d.f_p(x * x, 1, n) == pytest.approx(d.t_p(x, n), abs=1e-10)


# fixed values: upper points of published tables
@pytest.mark.parametrize(("got", "want"), [
    (d.t_p(2.228139, 10), 0.05), (d.t_p(2.750000, 30), 0.01), (d.chi_square_p(3.841459, 1), 0.05), (d.chi_square_p(23.209251, 10), 0.01), (d.f_p(3.325835, 5, 10), 0.05), (d.f_p(4.102821, 2, 10), 0.05),
])
def test_tables(got, want):
    assert got == pytest.approx(want, abs=1e-6)


def test_studentized_range():
    for q, k, v, p in ((3.877, 3, 10, 0.05), (5.294, 5, 20, 0.01), (3.314, 3, 1e6, 0.05), (4.041, 3, 8, 0.05)):
        assert d.range_p(q, k, v) == pytest.approx(p, abs=1e-4)
    for v in (2, 5, 17, 300, 20_000):
        for q in (0.5, 2.0, 3.7, 6.0):
            assert d.range_p(q, 2, v) == pytest.approx(d.t_p(q / math.sqrt(2), v), abs=1e-6)
    assert d.range_p(0.0, 4, 9) == 1.0 and d.range_p(200.0, 4, 9) < 1e-6


def test_tukey_of_groups(spark):
    rng = random.Random(5)
    data = [(g, rng.gauss(mean, 1.0)) for g, mean in (("a", 0), ("b", 0.1), ("c", 2.0)) for _ in range(25)]
    df = spark.createDataFrame(data, "g string, v double")
    got = {(r.a, r.b): r for r in models.tukey(df, "g", "v", ["a", "b", "c"]).collect()}
    assert set(got) == {("a", "b"), ("a", "c"), ("b", "c")} and got["a", "c"].p < 1e-4 < 0.05 < got["a", "b"].p
    assert all(r.p == pytest.approx(d.range_p(r.q, 3, 72), abs=1e-12) for r in got.values())


def test_odd_arguments(spark):
    df = spark.createDataFrame([(1.0, 5.0), (None, 5.0), (1.0, None), (1.0, 0.0), (float("nan"), 3.0), (-1.0, 4.0)], "t double, n double")
    got = [r.p for r in df.select(d.p_of_t(F.col("t"), F.col("n")).alias("p")).collect()]
    assert [x is None for x in got] == [False, True, True, True, True, False]
