"""The corpus pipeline as a whole against plain Python, stage by stage."""

from __future__ import annotations

import hashlib
import os
import random
import zlib
from collections import Counter

import corpus_pipeline

from .conftest import DDL, prose
from .test_pairs import components, decontam, holds
from .test_rows import law_of_rows, plain_bayes

from assayframe.llm import mixing, shared


def corpus(rng):
    rows = []
    for i in range(70):
        lang = ("en", "de")[i % 2]
        rows.append([i, prose(rng, lang, rng.randint(20, 60)), lang, "hot" if i % 3 == 0 else f"s{i % 4}", i])
    items = [(k, prose(rng, "en", 9)[:60].strip() + f" mark{k} {'z' * k}ing") for k in range(3)] + [(9, None)]
    for k in range(8):  # copies and near copies
        words = rows[k * 5][1].split()
        words[rng.randrange(len(words))] = "changed" if k % 2 else words[0]
        rows.append([100 + k, " ".join(words), "en", "s1", 1])
    rows += [[110 + k, f"{prose(rng, 'de', 12)} {items[k % 3][1].upper()} {prose(rng, 'de', 12)}", "de", "hot", 2] for k in range(6)]
    rows += [[120, None, "en", "s0", 0], [121, "", None, None, None], [122, "12 34 !!", "en", "s1", 0], [123, rows[1][1] + " | more @ here", "en", "s2", 0], [None, prose(rng, "en", 30), "en", "s3", 4], rows[3]]
    return [tuple(r) for r in rows], items


def raked(cells):
    """Plain proportional fitting of {(source, lang, topic): tokens}."""
    goals = []
    for at, target in enumerate(mixing.TARGETS.values()):
        sums = Counter()
        for key, n in cells.items():
            sums[key[at]] += n
        goal = {k: n**target.flatten for k, n in sums.items() if n}
        goals.append({k: x / sum(goal.values()) for k, x in goal.items()})
    weight = {k: float(n) for k, n in cells.items()}
    for _ in range(40):
        for at, goal in enumerate(goals):
            sums = Counter()
            for key, w in weight.items():
                sums[key[at]] += w
            weight = {k: w * goal[k[at]] / sums[k[at]] if sums[k[at]] else 0.0 for k, w in weight.items()}
    return weight


def test_run_matches_plain_stages(spark, tmp_path):
    rows, items = corpus(random.Random(12))
    spark.createDataFrame(rows, DDL).repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(items, "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    out = corpus_pipeline.run(spark, str(tmp_path))
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars", "shard", "slot"]
    got = out.collect()

    train = [(r[1], r[2]) for r in rows if r[1] is not None and r[2] is not None and (r[0] is None or zlib.crc32(str(r[0]).encode()) % 4 != 2)]
    said = plain_bayes([r[1] for r in rows], train)
    known = [r for r, (lang, p) in zip(rows, said, strict=True) if lang != "und" and p >= 0.5]
    assert {120, 121, 122}.isdisjoint({r[0] for r in known})

    _, names = components([(r[0], r[1]) for r in known])
    kept, seen = [], set()
    for r, name in sorted(zip(known, names, strict=True), key=lambda x: (x[0][0] is None, x[0][0] or 0)):
        if r[0] == name and name not in seen or name is None:
            kept.append(r)
            seen.add(name)
    assert len(kept) < len(known) - 3

    shares = lambda a, b: any(a[i : i + 8].lower() in b.lower() for i in range(len(a) - 7))  # noqa: E731  (no q-gram in common: too many edits)
    clean = [r for r in kept if not any(t and shares(t, r[1]) and holds(t, r[1]) for _, t in items)]
    assert {110, 111, 112} <= {r[0] for r in kept} and {110, 111, 112}.isdisjoint({r[0] for r in clean}) and len(clean) > 50

    def topic(text):
        counts = [sum(text.count(m) for m in marks) for _, marks in mixing.TOPICS]
        return mixing.TOPICS[counts.index(max(counts))][0] if max(counts) * mixing.TOPIC_TOKENS >= max(1, len(text.split())) else "prose"

    place = [(r[3] or "", r[2] or "", topic(r[1])) for r in clean]
    cells = Counter()
    for key, r in zip(place, clean, strict=True):
        cells[key] += len(r[1].split())
    weight = raked(cells)
    rate = min(1 / max(weight[k] / n for k, n in cells.items()), corpus_pipeline.KEEP_SHARE * sum(cells.values()) / sum(weight.values()))
    md5 = lambda x: hashlib.md5(x.encode()).hexdigest()
    chance = lambda doc, text: int(md5(f"0:{'' if doc is None else doc}:{md5(text or '')}")[:8], 16) / 2**32
    sampled = [r for key, r in zip(place, clean, strict=True) if chance(r[0], r[1]) < min(1.0, rate * weight[key] / cells[key])]
    assert 0 < len(sampled) < len(clean)
    assert Counter(tuple(r)[:5] for r in got) == Counter(sampled)
    law_of_rows([(r.shard, r.slot) for r in got], corpus_pipeline.SHARDS)
    assert decontam.Q == 8
    # of all that the stages have written only what the result reads is left
    left = {f.split("/assayframe-")[1].split("/")[1] for f in out.inputFiles()}
    place = shared._folder(spark).removeprefix("file://")
    assert len(left) == 2 and {x for x in os.listdir(place) if x.startswith(("pipeline-", "sharding-", "features-", "rates-"))} >= left
    assert not [x for x in os.listdir(place) if x.startswith("pipeline-")]


def test_stages_take_odd_tables(spark, tmp_path):
    """Empty tables, and documents with columns named like those that the stages make."""
    spark.createDataFrame([], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    odd = "doc_id long, text string, lang string, source string, n_chars long, lang_pred int, probability string, _tokens int, text_key int, row int"
    empty = spark.createDataFrame([], odd)
    rows = [(i, f"{'the river and the stone ' * 3} number {i} of all {i * 7}", "en", "s", 1, 5, "p", 6, 7, 8) for i in range(12)]
    full = spark.createDataFrame(rows, odd)
    for docs, least in ((empty, 0), (full, 1)):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, str(tmp_path))
            assert out.columns == [*docs.columns, *(["shard", "slot"] if name == "sharding" else [])], name
            assert all(tuple(r)[5:10] == (5, "p", 6, 7, 8) for r in out.collect()) and out.count() >= least


def test_tables_between_steps(spark, monkeypatch):
    """They lie in the shared folder, can be deleted, and a cluster without such a folder is an error."""
    import pytest

    table = shared.written(spark.range(5).toDF("a"), "some")
    assert "/assayframe-" in table.inputFiles()[0] and table.count() == 5
    shared.unwritten(table)
    with pytest.raises(Exception):
        spark.read.schema("a long").parquet(table.inputFiles()[0]).count()
    path = spark.conf.get("spark.checkpoint.dir")

    class Conf:
        def get(self, name, other=None):
            return {"spark.master": "spark://host:7077"}.get(name, other)

    class Session:
        conf = Conf()

    with pytest.raises(ValueError, match="checkpoint"):
        shared.shared_dir(Session())
    assert spark.conf.get("spark.checkpoint.dir") == path
