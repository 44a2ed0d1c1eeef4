"""Every query of the catalogue against its SQL in DuckDB, on the smallest tables."""

from __future__ import annotations

import math

import duckdb
import pytest

from assayframe.plans import dumps, extras, fields, figures, flows, registry, rest, tables  # noqa: F401

SF = "/root/testdata/sf0.001"
NAMES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in NAMES:
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return con


def plain(value):
    if value is None or isinstance(value, float) and math.isnan(value):
        return ""
    if isinstance(value, bool):
        return str(value)
    try:
        return f"{float(value):.6g}" if not isinstance(value, str) else value
    except (TypeError, ValueError):
        return str(value)


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query(spark, duck, name):
    df = registry.QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    got = sorted(tuple(plain(r[c]) for c in columns) for r in df.collect())
    assert got or name in ("p14_contains", "a37_filtered_count", "p23_unknown_keys")
    if name in registry.ORACLES:
        rel = duck.sql(registry.ORACLES[name])
        assert sorted(rel.columns) == columns
        at = [rel.columns.index(c) for c in columns]
        assert got == sorted(tuple(plain(r[i]) for i in at) for r in rel.fetchall())


def test_entry_module(spark):
    import __spark_entry__ as entry

    assert set(registry.QUERIES) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).count() > 0


def test_entry_without_the_corpus_part(tmp_path):
    """With the corpus operators and their pipeline deleted the rest is imported and lists its queries."""
    import shutil
    import subprocess
    import sys
    from pathlib import Path

    top = Path(__file__).resolve().parents[1]
    shutil.copytree(top / "assayframe", tmp_path / "assayframe", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(top / "__spark_entry__.py", tmp_path)
    said = subprocess.run([sys.executable, "-c", "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))"], cwd=tmp_path, capture_output=True, text=True)
    assert said.returncode == 0, said.stderr
    assert int(said.stdout.split()[0]) == len(registry.QUERIES)
