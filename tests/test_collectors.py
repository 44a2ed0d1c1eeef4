"""Collectors: records and failures of batches, streams and tables."""

from __future__ import annotations

import pytest

from assayframe.sources import collectors, runs
from assayframe.streaming import incremental


def folder_collector(name, folder, required=()):
    """Lines ``id,value`` of the files of a folder; a file with ``bad`` in it raises an error."""
    folder = str(folder)

    def items():
        import os

        return sorted(os.listdir(folder))

    def collect(item):
        with open(f"{folder}/{item}", encoding="utf-8") as lines:
            for line in lines:
                if "bad" in line:
                    raise ValueError(f"can't read {item}")
                key, _, value = line.strip().partition(",")
                yield {"id": key, "value": value}

    return collectors.Collector(name, "id string, value double", collect, items, required)


@pytest.fixture
def three(tmp_path):
    for name, files in {"a": {"1": "x,1\ny,2", "2": "z,3"}, "b": {"1": "u,1", "2": "bad", "3": "w,3"}, "c": {"1": ",7\nq,8"}}.items():
        (tmp_path / name).mkdir()
        for item, text in files.items():
            (tmp_path / name / item).write_text(text)
    return [folder_collector("a", tmp_path / "a"), folder_collector("b", tmp_path / "b"), folder_collector("c", tmp_path / "c", ["id"])]


def test_one_bad_item_leaves_the_others(spark, three, tmp_path):
    raw = runs.add_run(collectors.collected(spark, three, size=1), str(tmp_path / "out"))
    got = sorted((r.source, r.item, r.id, r.value) for r in collectors.all_records(raw, three).collect())
    assert got == [("a", "1", "x", 1.0), ("a", "1", "y", 2.0), ("a", "2", "z", 3.0), ("b", "1", "u", 1.0), ("b", "3", "w", 3.0), ("c", "1", "q", 8.0)]
    assert sorted((r.source, r.item, r.error) for r in collectors.failures(raw).collect()) == [("b", "2", "ValueError: can't read 2"), ("c", "1", "missing: id")]
    assert collectors.collected(spark, three, size=1).rdd.getNumPartitions() == 6


def test_a_bad_list_and_no_items(spark, three, tmp_path):
    broken = folder_collector("d", tmp_path / "nowhere")
    raw = collectors.collected(spark, [three[0], broken])
    assert [(r.source, r.item) for r in collectors.failures(raw).collect()] == [("d", None)]
    assert collectors.records(raw, three[0]).count() == 3
    assert collectors.collected(spark, [collectors.Collector("none", "a int", lambda item: [])]).count() == 0
    with pytest.raises(ValueError, match="names"):
        collectors.source_of([three[0], three[0]])


def test_a_stream_reads_new_items_only(spark, three, tmp_path):
    run = lambda: incremental.run_available(collectors.collected_stream(spark, three[:2]), f"{tmp_path}/c", f"{tmp_path}/rows")
    run()
    assert spark.read.parquet(f"{tmp_path}/rows").count() == 6
    (tmp_path / "a" / "3").write_text("n,9")
    run()
    rows = spark.read.parquet(f"{tmp_path}/rows")
    assert rows.count() == 7 and sorted(r.id for r in collectors.records(rows, three[0]).collect()) == ["n", "x", "y", "z"]


def test_items_of_a_table(spark):
    def words(text):
        if not text:
            raise ValueError("empty")
        return [{"id": w, "value": "no number"} for w in text.split()]

    own = collectors.Collector("words", "id string, value double", words)
    table = spark.createDataFrame([("1", "a b"), ("2", ""), ("3", None), (None, "c")], "k string, t string")
    raw = collectors.collected_from(table, [own], "k", "t")
    assert sorted((r.item, r.id, r.value) for r in collectors.records(raw, own).collect()) == [("1", "a", None), ("1", "b", None)]
    assert sorted(r.item for r in collectors.failures(raw).collect()) == ["2", "3"]
