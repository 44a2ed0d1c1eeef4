"""States of days: merged periods against whole runs, changed days, errors of sketches."""

from __future__ import annotations

import random
import statistics
from datetime import date, timedelta

import pytest

from assayframe.operators import states

DDL = "day date, kind string, value double, who string"


def made(rng, day, n):
    return [(day, rng.choice("ab"), rng.choice([None, round(rng.gauss(50, 9), 3)]), rng.choice([None, f"u{rng.randrange(4000)}"])) for _ in range(n)]


@pytest.fixture(scope="module")
def days():
    rng = random.Random(4)
    return {date(2024, 1, 20) + timedelta(i): made(rng, date(2024, 1, 20) + timedelta(i), 700) for i in range(25)}


def table(spark, path, days):
    rows = [r for own in days.values() for r in own]
    spark.createDataFrame(rows, DDL).write.mode("overwrite").partitionBy("day").parquet(path)
    return spark.read.schema(DDL).parquet(path)


ARGS = ("day", ["kind"], "value", "who")


def test_a_new_and_a_changed_day(spark, tmp_path, days):
    """Only the asked days are read; merged periods equal those of all days at once."""
    source = table(spark, f"{tmp_path}/source", days)
    order = sorted(days)
    states.update(source, f"{tmp_path}/states", order[:-1], *ARGS)
    states.update(source, f"{tmp_path}/states", order[-1:], *ARGS)
    changed = {**days, order[3]: days[order[3]][:100], order[5]: []}
    again = table(spark, f"{tmp_path}/changed", changed)
    states.update(again, f"{tmp_path}/states", [order[3], order[5]], *ARGS)
    exact = ["period", "kind", "n", "mean", "std", "least", "greatest"]
    got = states.merged(states.stored(spark, f"{tmp_path}/states"), ["kind"]).select(*exact, "distinct")
    states.update(again, f"{tmp_path}/full", order, *ARGS)
    want = states.merged(states.stored(spark, f"{tmp_path}/full"), ["kind"]).select(*exact, "distinct")
    got, want = (sorted(map(tuple, df.collect())) for df in (got, want))
    assert [r[:-1] for r in got] == [r[:-1] for r in want] and all(abs(a[-1] - b[-1]) <= 0.02 * b[-1] for a, b in zip(got, want, strict=True))
    plan = states.day_states(again.where("day IN (DATE '2024-01-23')"), *ARGS)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "day" in plan.split("PartitionFilters")[1][:120]


def test_merged_periods_against_plain_figures(spark, tmp_path, days):
    source = table(spark, f"{tmp_path}/source", days)
    for period in ("month", "year"):
        for r in states.merged(states.day_states(source, *ARGS), ["kind"], period, [0.1, 0.5, 0.9]).collect():
            own = [x for d, rows in days.items() for x in rows if x[1] == r.kind and (period == "year" or d.month == r.period.month)]
            values = sorted(x[2] for x in own if x[2] is not None)
            assert r.n == len(own) and r.mean == pytest.approx(statistics.fmean(values)) and r.std == pytest.approx(statistics.stdev(values))
            assert (r.least, r.greatest) == (values[0], values[-1])
            who = len({x[3] for x in own if x[3]})
            assert abs(r.distinct - who) <= 4 * 0.017 * who
            for q, v in zip([0.1, 0.5, 0.9], r.quantiles, strict=True):
                assert abs(sum(x <= v for x in values) / len(values) - q) < 0.03


def test_no_states(spark, tmp_path):
    assert states.stored(spark, f"{tmp_path}/none") is None
    empty = spark.createDataFrame([(None, "a", 1.0, "x")], DDL)
    assert states.day_states(empty, *ARGS).count() == 0


def test_no_digest_for_each_part(spark):
    """The exact median of a month is one digest, not one for each of its parts."""
    from assayframe.plans import extras

    plan = extras.a21_merged_states(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    digests = [line for line in plan.splitlines() if "Aggregate" in line and "percentile_approx" in line]
    assert digests and not any("l_partkey" in line for line in digests)
