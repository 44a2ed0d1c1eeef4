"""N-gram Jaccard join and decontamination against brute force."""

from __future__ import annotations

import random
import re
from collections import Counter
from itertools import combinations

import numpy as np
import pytest

from assayframe.llm import decontam, jaccard, tokens

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    words = re.findall("[^\x20\x09-\x0d]+", (text or "").translate(LOW))
    if len(words) >= 5:
        return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    return frozenset([tuple(words)] if words else [])


def components(rows):
    sets = [shingles(t) for _, t in rows]
    up = list(range(len(rows)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i, j in combinations(range(len(rows)), 2):
        both = len(sets[i] & sets[j])
        if sets[i] and sets[j] and 100 * both >= 75 * len(sets[i] | sets[j]):
            up[root(i)] = root(j)
    names = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            names[root(i)] = min(doc, names.get(root(i), doc))
    return sets, [names.get(root(i)) for i in range(len(rows))]


def check(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = Counter((r.doc_id, r.n_shingles, r.component_id) for r in jaccard.groups(df).collect())
    sets, names = components(rows)
    assert got == Counter((d, len(s), c) for (d, _), s, c in zip(rows, sets, names, strict=True))


def test_groups_match_brute_force(spark, corpus):
    check(spark, [(r[0], r[1]) for r in corpus])


def test_chains_of_frequent_tokens(spark, monkeypatch):
    """Many copies that each differ a little more: links chain, tokens are frequent, blocks are split."""
    monkeypatch.setattr(jaccard, "BLOCK_OWNERS", 7)
    rng = random.Random(3)
    rows = []
    for family in range(3):
        words = [f"f{family}w{i}" for i in range(90)]
        for i in range(40):
            if i % 3:
                words[rng.randrange(90)] = f"n{rng.randrange(10_000)}"
            cut = list(words)
            for _ in range(rng.randint(0, 3)):
                cut[rng.randrange(90)] = f"m{rng.randrange(10_000)}"
            rows.append((family * 100 + i, " ".join(cut)))
    check(spark, rows)


def test_threshold_is_inclusive(spark):
    base = [f"w{i}" for i in range(11)]  # 7 shingles
    rows = [(1, " ".join(base)), (2, " ".join(base[:10])), (3, "a b c"), (4, "A B c"), (5, "a b"), (6, " ".join(base[:8]))]
    check(spark, rows)


def test_empty_and_extra_columns(spark, empty):
    assert jaccard.groups(empty).count() == 0
    df = spark.createDataFrame([(1, "a b c d e f", 5, 6), (2, "a b c d e f", 7, 8), (2, "a b c d e f", 7, 8)], "doc_id long, text string, component_id int, owner int")
    assert sorted(r.component_id for r in jaccard.groups(df).collect()) == [1, 1, 1]
    kept = jaccard.keep_one(df)
    assert kept.columns == df.columns and [r.doc_id for r in kept.collect()] == [1]
    only = df.where("doc_id = 2")
    assert jaccard.keep_one(only).count() == 1


def test_sets_without_an_id_link(spark):
    """A set that only rows without an id hold links with others, and carries chains."""
    words = [f"w{i}" for i in range(120)]
    change = lambda *at: " ".join("x" + w if i in at else w for i, w in enumerate(words))
    rows = [(None, change(3)), (7, change()), (9, change(50, 55, 60)), (None, " ".join(words[::-1])), (None, " ".join(words[::-1])), (4, "other words")]
    check(spark, rows)
    kept = jaccard.keep_one(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert Counter(r.doc_id for r in kept) == Counter({7: 1, None: 1, 4: 1})


def test_one_id_with_several_texts(spark):
    """keep_one judges rows by their text, not by their id alone."""
    words = [f"w{i}" for i in range(60)]
    near = " ".join(["x", *words[1:]])
    rows = [(1, " ".join(words), 1), (2, near, 2), (2, "nothing like the others at all", 3), (2, "nothing like the others at all", 4), (3, None, 5), (3, None, 6), (3, "", 7)]
    df = spark.createDataFrame(rows, "doc_id long, text string, text_key int")
    check(spark, [r[:2] for r in rows])
    kept = jaccard.keep_one(df)
    assert kept.columns == df.columns
    got = Counter((r.doc_id, r.text) for r in kept.collect())
    assert got == Counter({(1, rows[0][1]): 1, (2, rows[2][1]): 1, (3, None): 2, (3, ""): 1})


def test_hot_keys_without_broadcast(spark, monkeypatch):
    """One group of many near copies with tiny blocks, and joins that may broadcast few rows only."""
    from assayframe.llm import shared

    monkeypatch.setattr(shared, "BROADCAST_ROWS", 3)
    monkeypatch.setattr(jaccard, "BROADCAST_ROWS", 3)
    monkeypatch.setattr(jaccard, "BLOCK_OWNERS", 3)
    monkeypatch.setattr(jaccard, "MEETINGS", 2)
    rng = random.Random(5)
    base = [f"w{i}" for i in range(100)]
    rows = []
    for i in range(40):
        words = list(base)
        words[rng.randrange(100)] = f"n{i}"
        rows.append((i, " ".join(words)))
    rows += [(40 + i, rows[i % 3][1]) for i in range(20)] + [(60 + i, " ".join(f"o{i}w{j}" for j in range(30))) for i in range(10)]
    check(spark, rows)
    assert sorted(r.doc_id for r in jaccard.keep_one(spark.createDataFrame(rows, "doc_id long, text string")).collect()) == [0, *range(60, 70)]


def test_keys_meet_for_every_linked_pair():
    """The prefix guarantee itself: any two linked sets share a key, whatever tokens are frequent."""
    rng = np.random.default_rng(5)
    for _ in range(400):
        n = int(rng.integers(3, 300))
        pool = rng.choice(1 << 40, size=3 * n, replace=False).astype(np.int64) * 2
        marked = pool | (rng.random(len(pool)) < rng.random())
        a = marked[:n]
        lost = int(rng.integers(0, n // 4 + 1))
        b = np.r_[a[lost:], marked[n : n + int(rng.integers(0, max(1, n // 3 - lost)))]]
        both = n - lost
        if 100 * both >= 75 * (n + len(b) - both):
            assert set(jaccard.keys(n, a)) & set(jaccard.keys(len(b), b)), (n, lost, len(b))


def test_token_hashes_are_of_words_alone():
    texts = ["a b c d e", "A  b\tc d\ne ", "a b c d", "é b c d e"]
    raw = [t.encode() for t in texts]
    data = np.frombuffer(b"".join(raw), np.uint8)
    sets = tokens.shingle_sets(data, np.cumsum([0, *map(len, raw)]))
    assert sets[0].tolist() == sets[1].tolist() and len({tuple(s.tolist()) for s in sets}) == 3


@pytest.fixture(scope="module")
def benchmark(spark):
    rng = random.Random(11)
    rows = [(i, " ".join("".join(rng.choices("abcdefghijklmnop", k=rng.randint(3, 8))) for _ in range(rng.choice([6, 20, 45])))) for i in range(12)]
    return spark.createDataFrame([*rows, (99, None), (98, "short"), (97, rows[0][1])], "item_id long, text string"), dict(rows)


def edited(rng, text, share):
    out = list(text)
    for _ in range(int(len(out) * share)):
        at = rng.randrange(len(out))
        out[at : at + 1] = rng.choice([["z"], [], ["z", out[at]]])
    return "".join(out)


def found_pairs(docs, table):
    return {(r.doc_id, r.item_id) for r in decontam.find(docs, table).collect()}


def test_decontamination_finds_planted_passages(spark, docs, benchmark):
    table, items = benchmark
    rng = random.Random(2)
    rows, truth = [], set()
    for i, text in items.items():
        rows += [(1000 + i, f"words before {text} and after"), (2000 + i, f"Before\n{text.upper().replace(' ', chr(10), 1)}"), (3000 + i, "x " + edited(rng, text, 0.02) + " y" if len(text) > 100 else text)]
        truth |= {(1000 + i, i), (2000 + i, i), (3000 + i, i)}
    truth |= {(d, 97) for d, i in truth if i == 0}
    planted = spark.createDataFrame(rows, "doc_id long, text string")
    assert found_pairs(planted, table) == truth
    assert decontam.find(docs, table).count() == 0
    mixed = docs.select("doc_id", "text").union(planted)
    assert Counter(r.doc_id for r in decontam.clean(mixed, table).collect()) == Counter(r.doc_id for r in docs.collect())
    assert decontam.clean(docs, table).columns == docs.columns


def test_decontamination_of_nothing(spark, docs, empty, benchmark):
    assert decontam.find(empty, benchmark[0]).count() == 0
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontam.find(docs, none).count() == 0 and decontam.clean(docs, none).count() == docs.count()


def slow_distance(p, t):
    row = [0] * (len(t) + 1)
    for i, c in enumerate(p):
        new = [i + 1]
        for j, d in enumerate(t):
            new.append(min(row[j] + (c != d), row[j + 1] + 1, new[j] + 1))
        row = new
    return min(row)


def plain(text):
    return "".join(" " if c.isspace() else c.lower() if len(c.lower()) == 1 else c for c in text)


def holds(item, text):
    """Brute force: any window of the item, anywhere in the text, with the edits it may have."""
    item, text = plain(item), plain(text)
    if len(item) < decontam.Q:
        return bool(item.strip()) and bool(re.search(r"(?<![^\W_])" + re.escape(item.strip()) + r"(?![^\W_])", text))
    size, e = min(len(item), decontam.WINDOW), int(decontam.edits_of(len(item)))
    if e == 0:
        return item in text
    return any(slow_distance(item[s : s + size], text) <= e for s in range(len(item) - size + 1))


def test_windows_match_brute_force(spark):
    """All windows at all places: edits of all kinds and numbers, parts of all lengths, scripts, short items."""
    rng = random.Random(8)
    item = lambda n, letters="abcde ": "".join(rng.choices(letters, k=n))
    items = [(0, item(60)), (1, item(90, "αβγδ ")), (2, item(40)), (3, item(33)), (4, item(20)), (5, item(9)), (6, "Short "), (7, item(49, "жзийк ")), (8, item(16)), (9, item(27)), (10, " " * 70), (11, "ab" * 40 + " end."), (12, "1+1=2")]
    rows = []
    for k, text in items:
        for n in range(40):
            a = rng.randrange(max(1, len(text) - 30))
            part = text[a : a + rng.choice([30, 44, 48, 52, 200])]
            for _ in range(rng.choice([0, 1, 2, 3, 4, 5])):
                at = rng.randrange(max(1, len(part)))
                part = part[:at] + rng.choice(["", "x", "xy"]) + part[at + rng.choice([0, 1]) :]
            rows.append((len(rows), item(rng.choice([0, 3, 25])) + (part.upper() if n % 2 else part) + item(rng.choice([0, 2, 30]))))
        rows.append((len(rows), text))
    rows += [(len(rows), None), (len(rows) + 1, "\tSHORT\n"), (len(rows) + 2, "shorts words"), (len(rows) + 3, ""), (len(rows) + 4, "q: 1+1=2 yes"), (len(rows) + 5, "11+1=2"), (len(rows) + 6, "-" * 60 + " " * 300 + "-"), (len(rows) + 7, "x" + "ba" * 200)]
    want = {(d, k) for d, text in rows for k, i in items if text and holds(i, text)}
    got = found_pairs(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert got == want and 60 < len(want) < len(rows) / 2


def test_alignment_against_full_matrix():
    rng = random.Random(4)
    for _ in range(100):
        e = rng.randint(0, 3)
        width, m = 2 * max(1, e) + 2 * e, rng.randint(1, 12)
        p, t = rng.choices([1, 2], k=m), rng.choices([1, 2, 3], k=m + width - 1)
        (edits,), (a,), (z,) = decontam.aligned(np.array([t], np.uint32), np.array([p], np.uint32), e)
        # paths that stay on the band's diagonals are as good as any where few edits are needed
        assert edits >= slow_distance(p, t) and slow_distance(p, t[a:z]) <= edits
        row = {(0, d): 0 for d in range(width)}
        for i in range(m):
            for d in range(width):
                row[i + 1, d] = min([row[i, d] + (p[i] != t[i + d])] + ([row[i, d + 1] + 1] if d + 1 < width else []) + ([row[i + 1, d - 1] + 1] if d else []))
        assert edits == min(row[m, d] for d in range(width))


def test_repeated_characters_are_bounded():
    """Runs in an item and in a text: as many hits as the text is long, and found as a whole."""
    import time
    import tracemalloc

    import pyarrow as pa

    known = decontam.indexes([(1, "start " + " " * 1500 + "end"), (2, "ab" * 700)])
    texts = [" " * 100_000, "x" + "ab" * 50_000, "start " + " " * 3000 + "end", "- " * 40_000]
    began = time.time()
    tracemalloc.start()
    got = decontam.passages(pa.array(texts), *known)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert [[x[0] for x in rows] for rows in got] == [[1], [2], [1], []]
    assert got[0][0][1:3] == (0, 100_000) and got[1][0][1] <= 1 and got[1][0][2] == 100_001
    assert most < 500e6 and time.time() - began < 30


def test_runs_give_what_their_places_give(monkeypatch):
    import pyarrow as pa

    rng = random.Random(21)
    known = decontam.indexes([(1, "row " + "-" * 60 + " total: 17 euro " + " " * 90), (2, "=" * 20 + "end of it " + "=" * 20), (3, "a b c d e " * 6)])
    part = lambda: rng.choice(["-", " ", "=", "a b c d e "]) * rng.choice([1, 30, 700]) + rng.choice(["row ", " total: 17 euro ", "end of it ", "x", ""])
    texts = pa.array(["".join(part() for _ in range(rng.randint(1, 8))) for _ in range(60)] + [None, "", "-" * 5000])
    short = decontam.passages(texts, *known)
    monkeypatch.setattr(decontam, "RUN", 1 << 20)
    assert decontam.passages(texts, *known) == short and sum(map(len, short)) > 40


def test_short_items_are_found_anywhere():
    import pyarrow as pa

    rng = random.Random(13)
    items = [(i, "".join(rng.choices("abcdefghij 0123456789", k=n)).strip() or "x") for i, n in enumerate([3, 5, 7, 8, 12, 16, 20, 27, 31] * 4)]
    texts = [f"before it, {text}; after" for _, text in items]
    got = decontam.passages(pa.array(texts), *decontam.indexes(items))
    assert all(i in {x[0] for x in got[i]} for i, _ in items)


def test_where_passages_start(spark, benchmark):
    table, items = benchmark
    item, text = max(items.items(), key=lambda x: len(x[1]))
    rows = [(1, f"zzzzzzz {text} zzz"), (2, "zzzzzzz " + text[:100] + "qqq" + text[100:]), (3, "Ünï😀 " + text.upper()), (4, "zz#" + text[10:70] + "#zz")]
    got = {r.doc_id: r for r in decontam.find(spark.createDataFrame(rows, "doc_id long, text string"), table).where(f"item_id = {item}").collect()}
    assert [(got[i].start, got[i].end) for i in (1, 2, 3, 4)] == [(8, 8 + len(text)), (8, 11 + len(text)), (5, 5 + len(text)), (3, 63)]
    assert got[1].edits == 0 and got[1].windows >= len(text) - 47


def test_long_texts_are_searched_in_pieces(spark, benchmark, monkeypatch):
    import pyarrow as pa

    table, items = benchmark
    text = max(items.values(), key=len)
    monkeypatch.setattr(decontam, "SLICE_BYTES", 700)
    monkeypatch.setattr(decontam, "OVERLAP", 256)
    long = "é fill " * 300 + text + " ünd " * 400 + text[:60] + " end" * 100
    known = decontam.indexes(list(items.items()))
    (pieces,) = decontam.passages(pa.array([long]), *known)
    monkeypatch.undo()
    (whole,) = decontam.passages(pa.array([long]), *known)
    assert pieces == whole and len(whole) == 2


def test_blocks_of_a_large_benchmark(spark, docs, benchmark, monkeypatch):
    table, items = benchmark
    planted = spark.createDataFrame([(1, items[1]), (2, items[2])], "doc_id long, text string")
    monkeypatch.setattr(decontam, "BLOCK_GRAMS", 500)
    assert found_pairs(planted, table) == {(1, 1), (2, 2)}
    assert decontam.clean(planted, table).count() == 0


def test_decontamination_finds_partial_passages_from_every_start(spark, benchmark):
    table, items = benchmark
    item, text = max(items.items(), key=lambda x: len(x[1]))
    assert len(text) > 200
    rng, rows = random.Random(6), []
    for size in (decontam.WINDOW, 80, 120):
        for at in range(len(text) - size + 1):
            part = text[at : at + size]
            rows.append((len(rows), f"words before it {part} and after"))
            if at % 5 == 0:  # one byte of it is changed
                cut = rng.randrange(size)
                rows.append((len(rows), f"words before it {part[:cut]}Z{part[cut + 1 :]} and after"))
    planted = spark.createDataFrame(rows, "doc_id long, text string")
    assert Counter((r.doc_id, r.item_id) for r in decontam.find(planted, table).collect()) == Counter((d, item) for d, _ in rows)
    assert decontam.clean(planted, table).count() == 0
