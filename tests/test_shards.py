"""Joins against shard files: first values, gaps filled by later shards, no exchange above the bucketed scans."""

from __future__ import annotations

import pytest

from assayframe.operators import shards


@pytest.fixture
def sides(spark):
    left = spark.createDataFrame([(1, "a", 9), (1, "b", 9), (2, "c", 9), (3, "d", 9), (None, "e", 9)], "k long, name string, area int")
    first = spark.createDataFrame([(1, 5, "x"), (1, 2, "y"), (2, 1, None), (None, 7, "z")], "id long, n int, zone string")
    second = spark.createDataFrame([(1, 1, 100), (2, 4, 200), (2, 3, 300)], "k long, n int, size int")
    third = spark.createDataFrame([(2, 1, "w"), (9, 1, "v")], "k long, n int, area string")
    cut = [shards.Shard(first, {"id": "k", "zone": "area"}), shards.Shard(second), shards.Shard(third)]
    own = shards.bucketed(left, "k", 4), shards.stacked(cut, "k", {"area": "string", "size": "long"}, {"n": "int"}, 4)
    yield own
    for table in own:
        table.drop(spark)


def test_first_values_win_and_gaps_are_filled(spark, sides):
    got = sorted(map(tuple, shards.enriched(*sides, ["area", "size"], ["n"], spark).select("name", "k", "area", "size").collect()))
    assert got == [("a", 1, "y", 100), ("b", 1, "y", 100), ("c", 2, "w", 300), ("d", 3, None, None), ("e", None, None, None)]


def test_matches_of_each_shard(spark, sides):
    got = sorted((r.name, r._shard, r.area, r.size) for r in shards.matched(*sides, ["area", "size"], ["n"], spark).collect())
    assert got == [("a", 0, "y", None), ("a", 1, None, 100), ("b", 0, "y", None), ("b", 1, None, 100), ("c", 0, None, None), ("c", 1, None, 300), ("c", 2, "w", None)]


def test_no_exchange_above_the_buckets(spark, sides):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for out in (shards.enriched(*sides, ["area", "size"], ["n"], spark), shards.matched(*sides, ["area", "size"], ["n"], spark)):
            plan = out._jdf.queryExecution().executedPlan().toString()
            assert "SortMergeJoin" in plan and "Exchange" not in plan, plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_no_shards():
    with pytest.raises(ValueError):
        shards.stacked([], "k", {}, {})
