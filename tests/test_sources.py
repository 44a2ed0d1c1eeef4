"""Readers, sinks and incremental runs on small files."""

from __future__ import annotations

import json
import time

import pytest
from pyspark.sql import functions as F

from assayframe.sources import readers, sinks
from assayframe.streaming import incremental


def test_delimited(spark, tmp_path):
    path = tmp_path / "a" / "TestResults_1.csv"
    path.parent.mkdir()
    path.write_bytes("Id,Name,Level\n1,Caf\xe9,2.5\n2,x,y\n".encode("latin-1"))
    df = readers.read_delimited(spark, str(path), "Id string, Name string, Level double", {"Id": "sample_id"}, encoding="ISO-8859-1")
    assert [tuple(r) for r in df.collect()] == [("1", "Café", 2.5), ("2", "x", None)]
    assert readers.read_delimited(spark, str(tmp_path / "none.csv"), "a string", missing_ok=True).count() == 0
    (tmp_path / "a" / "No Data.csv").write_text("Id,Name,Level\n9,z,1\n")
    assert readers.read_tree(spark, str(tmp_path), "Id string, Name string, Level double", skip="no data").count() == 2


def test_wide_encoding(spark, tmp_path):
    path = tmp_path / "x.tsv"
    path.write_bytes("a\tb\n1\tü\n".encode("utf-16"))
    assert [tuple(r) for r in readers.read_delimited(spark, str(path), "a string, b string", sep="\t", encoding="UTF-16", skip_bad=True).collect()] == [("1", "ü")]


def test_ledger(spark, tmp_path):
    folder = tmp_path / "ledger"
    folder.mkdir()
    (folder / "1.json").write_text("\n".join(json.dumps({"key": k, "value": {"v": v}}) for k, v in (("a", 1), ("b", 2), ("a", 3))))
    assert sorted(tuple(r) for r in readers.read_ledger(spark, str(folder), "v int").collect()) == [("a", 3), ("b", 2)]
    sinks.append_ledger(spark.createDataFrame([("c", 5)], "k string, v int"), str(folder), "k")
    assert sorted(r.key for r in readers.read_ledger(spark, str(folder), "v int").collect()) == ["a", "b", "c"]


def test_api_table(spark, tmp_path):
    doc = {"meta": {"view": {"columns": [{"name": "Brand Name"}, {"name": "THC"}]}}, "data": [["x", "1"], ["y", "2"]]}
    (tmp_path / "t.json").write_text(json.dumps(doc))
    df = readers.read_api_table(spark, str(tmp_path / "t.json"), ["thc", "brand_name", "other"])
    assert [tuple(r) for r in df.collect()] == [("1", "x", None), ("2", "y", None)]


def test_report(spark, tmp_path):
    lines = ["Some Lab", "1/2/2024 Blue", "Dream", "Potency", "THCA 21.5 %", "THC ND", "Microbes", "Yeast <10 CFU/g", "1/3/2024 Haze", "Potency", "THCA 3 %"]
    (tmp_path / "r.txt").write_text("\n".join(lines))
    got = readers.read_report(spark, str(tmp_path / "r.txt"), {"Potency": "cannabinoids", "Microbes": "microbes"}, skip=["Some Lab"]).orderBy("sample").collect()
    assert [(r.date, r.product_name) for r in got] == [("1/2/2024", "Blue Dream"), ("1/3/2024", "Haze")]
    assert [tuple(x) for x in got[0].results] == [("cannabinoids", "THCA", "21.5", "%"), ("cannabinoids", "THC", "ND", ""), ("microbes", "Yeast", "<10", "CFU/g")]


def test_pages_and_files(spark, tmp_path):
    html = '<html><title>T</title><body><a class="x" href="u">l</a><div class="card big"> a <b>b</b></div><script>no</script></body></html>'
    df = spark.createDataFrame([(html,)], "h string")
    got = df.select(*[c.alias(k) for k, c in readers.page_fields(F.col("h")).items()], readers.tagged_text(F.col("h"), "div", "class", "card").alias("cards")).first()
    assert (got.title, got.links, got.cards, got.visible) == ("T", ["u"], ["a b"], "T l a b")
    (tmp_path / "f.bin").write_bytes(b"abc")
    assert readers.parse_files(spark, str(tmp_path), lambda path, content: [{"n": len(content)}], "n int").first().n == 3
    assert readers.serial_ids(spark, 2).count() == 100 and readers.letter_pairs(spark).distinct().count() == 676
    assert readers.dated_ids(spark, "2024-01-01", "2024-01-02", 3).count() == 6


def test_upserts(spark, tmp_path):
    path, ledger = str(tmp_path / "docs"), str(tmp_path / "done")
    new = spark.createDataFrame([("a", 1), ("b", 2)], "id string, v int")
    sinks.upsert_documents(new, path, ledger)
    assert spark.read.parquet(path).count() == 2
    assert sinks.upsert_documents(spark.createDataFrame([("b", 9), ("c", 3)], "id string, v int"), path, ledger).count() in (0, 1)
    assert sorted(r.id for r in spark.read.parquet(path).collect()) == ["a", "b", "c"]
    table = str(tmp_path / "years")
    rows = lambda *x: spark.createDataFrame(list(x), "k string, v int, year int")
    sinks.upsert_partitions(rows(("a", 1, 2020), ("b", 1, 2021)), table, ["k"], "year", ["v"])
    sinks.upsert_partitions(rows(("b", 7, 2021), ("c", 1, 2021)), table, ["k"], "year", ["v"])
    assert sorted((r.k, r.v) for r in spark.read.parquet(table).collect()) == [("a", 1), ("b", 1), ("c", 1)]


def test_changed_only(rows):
    before = rows([("a", 1, "t0"), ("b", 2, "t0")], "k string, n int, updated_at string")
    now = rows([("a", 1, "t1"), ("b", 3, "t1"), ("c", 1, "t1")], "k string, n int, updated_at string")
    assert sorted(r.k for r in sinks.changed_only(now, before, ["k"]).collect()) == ["b", "c"]


def test_incremental(spark, tmp_path):
    """A second run reads only the files that came since; keys that were seen stay out."""
    source, place = tmp_path / "in", tmp_path / "run"
    schema = "k string, v int"
    put = lambda name, data: spark.createDataFrame(data, schema).coalesce(1).write.mode("append").parquet(str(source))
    run = lambda: incremental.run_available(incremental.first_seen(incremental.new_files(spark, str(source), schema), ["k"]), f"{place}/c", f"{place}/out")
    put("1", [("a", 1), ("a", 1), ("b", 2)])
    run()
    time.sleep(0.1)
    put("2", [("b", 3), ("c", 4)])
    run()
    assert sorted(r.k for r in spark.read.parquet(f"{place}/out").collect()) == ["a", "b", "c"]
    each = incremental.publish_unseen(f"{place}/docs", f"{place}/done", "k")
    incremental.run_available(incremental.new_files(spark, str(source), schema), f"{place}/c2", each=each)
    assert spark.read.parquet(f"{place}/docs").count() == 3


@pytest.mark.parametrize(("order", "end", "tasks"), [("utf-16-le", "\r\n", 6), ("utf-16-be", "\r\n", 1), ("utf-16-le", "\n", 1)])
def test_wide_files_are_split(spark, tmp_path, order, end, tasks):
    """One file of UTF-16 with characters whose bytes look like a line's end: the rows of a plain reading, by many tasks where that is safe."""
    rows = [(i, f"näme {i} ਅĀ മ", i / 4) for i in range(4000)]
    path = tmp_path / "x.tsv"
    path.write_bytes((f"\ufeffid\tname\tvalue{end}" + "".join(f"{a}\t{b}\t{c}{end}" for a, b, c in rows)).encode(order))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        df = readers.read_delimited(spark, str(path), "id long, name string, value double", {"name": "label"}, sep="\t", encoding="UTF-16")
        assert df.rdd.getNumPartitions() >= tasks
        assert sorted(map(tuple, df.collect())) == rows and df.columns == ["id", "label", "value"]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_reports_are_split(spark, tmp_path):
    """Samples, headers and wrapped names that lie across the splits of a file: as of one reading."""
    text, want = ["a line before all"], []
    for i in range(120):
        text += [f"{i % 12 + 1}/{i % 28 + 1}/2024 Product {i}"] + (["with a long name"] if i % 5 == 0 else [])
        want.append([f"Product {i}" + (" with a long name" if i % 5 == 0 else ""), []])
        for name, kind in (("Cannabinoids", "potency"), ("Terpenes", "terpenes"))[: i % 3]:
            text.append(name)
            for k in range(i % 7):
                text.append(f"analyte {k}  {k}.5 mg/g")
                want[-1][1].append((kind, f"analyte {k}", f"{k}.5", "mg/g"))
            text.append("page 1 of 9")
    for name in ("a.txt", "b.txt"):
        (tmp_path / name).write_text("\n".join(text))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size in ("300", "1g"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            df = readers.read_report(spark, str(tmp_path), {"cannabinoids": "potency", "terpenes": "terpenes"}, skip=["page"])
            got = sorted((r.file[-5:], r["sample"], r.product_name, tuple(map(tuple, r.results))) for r in df.collect())
            assert got == [(f, i + 1, name, tuple(results)) for f in ("a.txt", "b.txt") for i, (name, results) in enumerate(want)]
        assert "SinglePartition" not in df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_report_in_short_stretches(spark, tmp_path, monkeypatch):
    """Samples and headers go on from one stretch of lines to the next."""
    said = [line for i in range(40) for line in (f"1/2/2024 Order {i}", "goes on", "Cannabinoids", *(f"a{j} {i}.{j} mg" for j in range(i % 5)), "page 1", "Terpenes", f"b {i} %")]
    (tmp_path / "r.txt").write_text("\n".join(said))
    read = lambda: sorted((r.sample, r.product_name, [tuple(x) for x in r.results]) for r in readers.read_report(spark, str(tmp_path / "r.txt"), {"cannabinoids": "potency", "terpenes": "terpenes"}, skip=["page"]).collect())
    want = [(i + 1, f"Order {i} goes on", [*(("potency", f"a{j}", f"{i}.{j}", "mg") for j in range(i % 5)), ("terpenes", "b", str(i), "%")]) for i in range(40)]
    for lines in (1, 2, 4, 1 << 16):
        monkeypatch.setattr(readers, "STRETCH", lines)
        assert read() == want
