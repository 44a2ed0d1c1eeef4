"""SentencePiece against the library, clustering and the divergence audit against plain versions and SQL."""

from __future__ import annotations

import hashlib
import random
from collections import Counter
from fractions import Fraction
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from assayframe.llm import centroids, divergence, pieces

from .test_rows import duck, same_rows

public_tokenizers = pytest.importorskip("public_tokenizers")
PATH = public_tokenizers.path("piece_bpe_32k.model")


# -- SentencePiece --------------------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def model():
    return pieces.load(PATH)


@pytest.fixture(scope="module")
def library():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=PATH)


def sha(x):
    return hashlib.sha256(x if isinstance(x, bytes) else x.encode()).hexdigest()


def described(library, text):
    ids = library.encode(text or "")
    return len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids))


def odd_texts(rng, model, n):
    letters = [*"abethnosAT.=-1é中国😀́\n\t\x00", " ", "  ", "▁", "the", "ing", "    ", "aaaaa", "<s>", "<0x0A>"]
    names = list(model.pieces)
    for i in range(n):
        some = letters if i % 2 else names
        yield "".join(rng.choice(some) for _ in range(rng.randint(0, 20))).replace("▁", rng.choice(["▁", " "]))


def test_pieces_match_the_library(model, library):
    texts = [*odd_texts(random.Random(1), model, 3000), *(c * n for c in "aA= -中xé.\n" for n in (1, 7, 33, 64, 257))]
    assert list(pieces.described(model, texts)) == [described(library, x) for x in texts]
    for x in texts[:500]:
        assert model.ids(x) == library.encode(x) and model.text(model.ids(x)) == library.decode(library.encode(x))


def test_decoding_of_any_ids(model, library):
    """Bytes that are no characters, control pieces, ids that don't begin with white space."""
    rng = random.Random(4)
    for _ in range(500):
        ids = [rng.choice([rng.randrange(3, 259), rng.randrange(259, 32_000), 1, 2]) for _ in range(rng.randint(0, 12))]
        assert model.text(ids) == library.decode(ids), ids
    with pytest.raises(ValueError, match="no piece"):
        model.text([40_000])


def test_pieces_of_whole_documents(spark, docs, corpus, empty, library):
    got = Counter(map(tuple, pieces.digest(docs, PATH).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256").collect()))
    assert got == Counter((r[0], *described(library, r[1])) for r in corpus)
    assert pieces.digest(empty, PATH).count() == 0
    there = pieces.encode(docs.withColumn("IDS", F.lit(1)), PATH)
    back = pieces.decode(there.withColumnRenamed("text", "before"), PATH)
    assert there.columns == ["doc_id", "text", "lang", "source", "n_chars", "ids"]
    assert all(r.text == (r.before or "") for r in back.collect())


def test_long_texts_and_full_memory(model, library, monkeypatch):
    """Chunks that are not kept, texts in several lots, a memory that is emptied now and then."""
    rng = random.Random(6)
    texts = ["".join(rng.choice("abcdefghij") for _ in range(40_000)), " ".join(rng.choice(["word", "two words", "x" * 60, "ünd\n"]) for _ in range(20_000)), "", None, "z"]
    monkeypatch.setattr(pieces, "LOT", 3000)
    monkeypatch.setattr(pieces, "NEW", 50)
    monkeypatch.setattr(pieces, "KEPT", 10)
    monkeypatch.setattr(pieces, "_STRETCH", 100)
    fresh = pieces.load(PATH)
    assert list(pieces.described(fresh, texts)) == [described(library, x) for x in texts]


def test_small_vocabularies_match_plain_merging():
    """Vocabularies that merge their own pieces in order, and one with equal scores: against merging of the whole text."""
    rng = random.Random(9)
    for trial in range(25):
        names = list("abc")
        while len(names) < 14:
            x = rng.choice(names) + rng.choice(names)
            if x not in names and len(x) < 8:
                names.append(x)
        own = {x: (i + 256, float(-i)) for i, x in enumerate(names)}
        m = pieces.Model(own, list(range(256)), [None] * 256 + [x.encode() for x in names])
        texts = ["".join(rng.choice("abc") for _ in range(rng.randint(1, 30))) for _ in range(60)]
        for x in texts:
            assert [m.names[i] for i in m.chunk_ids(x)] == m.merged(x), (trial, x)
        m.learn(sorted(set(texts)))
        assert all(m.kept[x][2] == x.encode() and m.kept[x][0] == len(m.merged(x)) for x in texts)


def test_pairs_are_judged_as_merging_judges_them(model):
    rng = random.Random(2)
    ids = list(model.names)
    for a, b in ((rng.choice(ids), rng.choice(ids)) for _ in range(5000)):
        whole = [model.names[a], model.names[b]]
        assert model._stays(a, b) == (model.merged("".join(whole)) == whole)


# -- centroid clustering --------------------------------------------------------------------------------------------


def plain_clusters(rows, k, rounds):
    kept = [(i, [int(np.floor(np.float64(1024) * x)) for x in v]) for i, v in rows if v is not None and len(v) == 64 and all(x is not None and np.isfinite(x) for x in v)]
    first = sorted(kept, key=lambda r: (r[0] is None, sha(f"3:{r[0]}"), r[1]))[:k]
    means = [r[1] for r in first]
    square = lambda v, c: sum((a - b) ** 2 for a, b in zip(v, c, strict=True))
    judge = lambda: [min((square(v, c), j) for j, c in enumerate(means)) for _, v in kept]
    for _ in range(rounds):
        place = [j for _, j in judge()]
        for j in range(len(means)):
            own = [v for (_, v), p in zip(kept, place, strict=True) if p == j]
            if own:
                means[j] = [sum(c) // len(own) for c in zip(*own, strict=True)]
    last = judge()
    inertia = Counter()
    for d, j in last:
        inertia[j] += d
    return Counter((i, j, d, inertia[j], inertia.total(), sha(",".join(map(str, means[j])))) for (i, _), (d, j) in zip(kept, last, strict=True))


def vectors_of(rng, n, groups=5):
    centers = [[rng.uniform(-2, 2) for _ in range(64)] for _ in range(groups)]
    return [(i, [x + rng.gauss(0, 0.2) for x in rng.choice(centers)]) for i in range(n)]


def check_clusters(spark, rows, k=8, rounds=10):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    rows = [(r.vec_id, r.embedding) for r in df.collect()]  # as floats
    out = centroids.digest(df, k, rounds).select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
    assert Counter(map(tuple, out.collect())) == plain_clusters(rows, k, rounds)


def test_clusters_match_plain_ones(spark):
    rng = random.Random(3)
    rows = vectors_of(rng, 300)
    odd = [(900, None), (901, []), (902, [1.0] * 63), (903, [1.0] * 63 + [None]), (904, [float("nan")] * 64), (905, [float("inf")] * 64), (906, [0.0] * 64), (906, [0.0] * 64), (None, [0.5] * 64)]
    check_clusters(spark, rows + odd + rows[:20], rounds=4)


def test_clusters_of_equal_and_few_vectors(spark):
    """Equal vectors start several clusters: the smallest number takes all, the others stay empty."""
    check_clusters(spark, [(i, [0.25] * 64) for i in range(30)] + [(50, [-1.0] * 64)], rounds=2)
    check_clusters(spark, [(i, [float(i)] * 64) for i in range(3)], rounds=2)
    assert centroids.digest(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


def test_clusters_keep_columns_and_tell_of_large_components(spark):
    df = spark.createDataFrame([(i, [i / 7] * 64, "x", 5) for i in range(20)], "vec_id long, embedding array<double>, whole string, Cluster int")
    out, found = centroids.assigned(df, clusters=2, rounds=2)
    assert out.columns == ["vec_id", "embedding", "whole", "cluster", "distance"] and out.count() == 20 and sum(found.counts) == 20
    with pytest.raises(Exception, match="range of exact"):
        centroids.digest(spark.createDataFrame([(1, [1e9] * 64)], "vec_id long, embedding array<double>")).collect()


def test_screening_leaves_out_most_and_loses_none():
    rng = np.random.default_rng(5)
    middle = rng.integers(-3000, 3000, (8, 64))
    rows = middle[rng.integers(0, 8, 2000)] + rng.integers(-300, 300, (2000, 64))
    number, distance, asked = centroids.nearest(rows, centroids.norms(rows), middle)
    every = ((rows[:, None] - middle[None]) ** 2).sum(axis=2)
    assert (number == every.argmin(axis=1)).all() and (distance == every.min(axis=1)).all() and asked < 2.5 * len(rows)
    ties = np.repeat(middle[:1], 8, axis=0)
    assert (centroids.nearest(rows, centroids.norms(rows), ties)[0] == 0).all()


# -- divergence audit -----------------------------------------------------------------------------------------------


def audit_rows(seed=5):
    rng = random.Random(seed)
    words = ["river", "stone", "Über", "die", "the", "naïve", "ßtraße", "中文", "x", "THE", "a1b", "of"] + [f"w{chr(97 + i)}{chr(97 + j)}" for i in range(9) for j in range(9)]
    rows = []
    for i in range(260):
        source = "hot" if i % 3 == 0 else f"s{i % 11}"
        some = words[: 12 + i % 60]
        rows.append((i, " ".join(rng.choice(some) + rng.choice(["", ".", "-b"]) for _ in range(rng.randint(0, 40))), rng.choice(["en", "de", None]), source, 0))
    return rows + [(900, None, "en", None, 0), (901, "", "", "alone", 0), (902, "once only here", "fr", "one", 0), (None, "the the the", None, "", 0), rows[3], rows[3]]


def test_audit_matches_sql(spark):
    rows = audit_rows()
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    same_rows(divergence.audit(df, top=9), *duck(rows, divergence.oracle(top=9)))


def test_audit_with_many_blocks_seats_and_heaps(spark, monkeypatch):
    """One source a seat, blocks of a few terms, heaps that are passed on, joins without a broadcast of all groups."""
    from assayframe.llm import shared

    rows = audit_rows(6)
    monkeypatch.setattr(divergence, "HELD", 20)
    monkeypatch.setattr(divergence, "ROUNDS", 2)
    monkeypatch.setattr(shared, "BROADCAST_ROWS", 4)
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").withColumns({"term": F.lit(1), "Lang_n": F.lit(2)})
    same_rows(divergence.audit(df, top=5, block_terms=20, seat_groups=2), *duck(rows, divergence.oracle(top=5)))


def test_audit_of_little(spark, empty):
    assert divergence.audit(empty).count() == 0
    one = spark.createDataFrame([(1, "a b c", "en", "s")], "doc_id long, text string, lang string, source string")
    assert divergence.audit(one).count() == 0
    two = one.union(spark.createDataFrame([(2, None, "en", "t")], one.schema))
    assert sorted((r.source, r.item, r.value, r["rank"]) for r in divergence.audit(two).collect()) == [("s", "t", 0, 1), ("t", "s", 0, 1)]


@pytest.mark.parametrize("seats", [2, 4, 6, 10])
def test_every_two_seats_meet_once(seats):
    met = Counter()
    for turn in range(seats - 1):
        pairs = {s: divergence.partner(s, turn, seats) for s in range(seats)}
        assert all(pairs[pairs[s]] == s != pairs[s] for s in pairs)
        met.update(frozenset(x) for x in pairs.items())
    assert met == Counter({frozenset(x): 2 for x in combinations(range(seats), 2)})
    hosts = Counter(divergence.host(a, b) for a, b in combinations(range(seats), 2))
    assert max(hosts.values()) - min(hosts.get(s, 0) for s in range(seats)) <= 1 + seats // 2


def test_shares_are_exact():
    rng = random.Random(8)
    for _ in range(2000):
        total = rng.randint(1, divergence.MOST)
        n = rng.randint(0, total - 1)
        assert divergence.shares(np.array([n]), total).tolist() == [1 + int(Fraction(10**9 * (n + 1), total))]


def test_shares_in_spark_are_exact(spark):
    rng = random.Random(8)
    rows = [(n, t) for t in (rng.randint(1, 10 ** rng.randint(1, 13)) for _ in range(300)) for n in [rng.randint(0, t - 1)]] + [(divergence.MOST - 1, divergence.MOST)]
    got = spark.createDataFrame(rows, "n long, t long").select("n", "t", divergence.share(F.col("n"), F.col("t")).alias("p")).collect()
    assert all(r.p == 1 + 10**9 * (r.n + 1) // r.t for r in got)
