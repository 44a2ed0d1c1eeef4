"""N-gram Jaccard join: near-duplicate groups by token-combination prefixes.

Documents are sets of distinct five-word shingles (tokens).  Two documents
link when 100 * intersection >= 75 * union.  All links between different sets
are found, but large groups are never spelled out as pairs of rows.

1. Fold.  Documents with equal sets are one *owner*, named by a hash of the
   set.  A and B can link only if they share ceil(0.75 |A|) tokens, so A
   misses at most t = |A| - ceil(0.75 |A|) of its tokens in B.
2. Sift.  Every owner sends the t + K first tokens in hash order, K = |A| / 12.
   Linked owners share min(K_A, K_B) tokens of these extended prefixes.  Owners
   with fewer tokens that anybody else has are out; most documents end here.
   The rest send all their tokens and are sifted again by the full bound.
3. Sign.  Tokens of fewer than ``FREQUENT`` owners are rare, others frequent.
   The rare ones come first in the prefix and are indexed singly.  Frequent
   ones are dealt into classes by hash; the prefix is extended until taking
   away any t tokens leaves a rare one or two of one class, and the pairs of
   each class are indexed.  Linked owners share an indexed key.
4. Verify.  Owners gather round the owner with the most shared tokens that
   they share a key with, and by size, in blocks of bounded size.  Two blocks
   meet in one task, which counts all intersections by matrix products over
   slices of the vocabulary, and returns a spanning forest of the links.
   First each block meets itself and, for each of its keys, the block that
   holds most of the key's owners.  Labels spread over these links.  Then the
   other blocks with a common key meet, but for those of too different sizes
   and those whose owners are all in one group already: a large dense group
   takes as many meetings as it has blocks, not as many as pairs of them.
5. Join.  Labels spread over the forests until nothing changes.

Frequent tokens are pre-aggregated: a token that many owners sent together
have is sent to its counting task once for all of them, and its owners go
around that task.  Hashes have 63 bits (tokens) and 64 bits (sets).  Joins to
keys that may be hot are those of ``shared.looked_up``; a block in many
meetings is sent in as many copies as its meetings need.

Defined cases: null text and text without words have an empty set, n_shingles
0, and link with nothing; repeated rows of one doc_id are in one group if
their texts are, and each row is in the group of its own text if they are not;
rows with null doc_id link like others, but never name a group unless all its
rows are such; other columns are ignored by ``groups`` and kept by
``keep_one``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import BROADCAST_ROWS, looked_up, map_batches, private, record_batch, text_slices, unwritten, written
from .tokens import mix, set_hash, shingle_sets

WORDS = 5
#: A token of so many owners is frequent.
FREQUENT = 8
#: Sets below this size link only with equal sets.
SMALLEST = 3
#: Owners and tokens that a verification block holds on average at most.
BLOCK_OWNERS, BLOCK_TOKENS = 300, 400_000
#: Meetings that one copy of a block's rows serves.
MEETINGS = 64
_VOCABULARY = 4096
#: Tokens that a task gathers before it sorts and sends them (8 bytes each, some ten times that while sorting).
HELD_TOKENS = 1 << 20

_DOC = pa.struct([("doc_id", pa.int64()), ("text_key", pa.int64())])
_SENT = pa.schema([("token", pa.int64()), ("owner", pa.int64()), ("n", pa.int64()), ("doc", _DOC)])
_SENT_DDL = "token long, owner long, n long, doc struct<doc_id: long, text_key: long>"


def need(n):
    """ceil(0.75 n): tokens of a set of n that a linked set has too."""
    return (75 * n + 99) // 100


def spare(n):
    """Tokens by which the prefix of a set of n is extended."""
    return n // 12 if n >= 24 else 1


# -- tokens of documents, and which of them anybody else has ---------------------------------------------------------


def _send(full: bool):
    """Arrow batches of (doc, text) to rows: tokens of owners, and one row for each document.

    A document's row has a null token.  n is 0 for a token sent to be
    counted, -1 for one that is known to be frequent and need not be, and the
    number of owners sent together where one row counts for all of those.
    """

    def flush(tokens: list[np.ndarray], holders: list[int]) -> Iterator[pa.RecordBatch]:
        if not tokens:
            return
        token = np.concatenate(tokens).view(np.int64)
        owner = np.repeat(np.array(holders, np.int64), [len(x) for x in tokens])
        order = np.argsort(token, kind="stable")
        token, owner = token[order], owner[order]
        heads = np.flatnonzero(np.r_[True, token[1:] != token[:-1]]) if len(token) else np.zeros(0, np.int64)
        count = np.diff(np.r_[heads, len(token)])
        kind = np.where(np.repeat(count >= FREQUENT, count), -1, 0)
        pings = heads[count >= FREQUENT]
        token, owner, kind = np.r_[token, token[pings]], np.r_[owner, owner[pings]], np.r_[kind, count[count >= FREQUENT]]
        for at in range(0, len(token), 1 << 17):
            part = slice(at, at + (1 << 17))
            yield record_batch(_SENT, token[part], owner[part], kind[part], pa.nulls(len(token[part]), _DOC))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, holders, seen, held = [], [], set(), 0
        for batch in batches:
            owners, sizes = [], []
            for _, offsets, data in text_slices(batch.column(1)):
                for found in shingle_sets(data, offsets, WORDS):
                    n = len(found)
                    sizes.append(n)
                    owner = set_hash(found) if n else None
                    owners.append(owner)
                    if n >= SMALLEST and owner not in seen:
                        seen.add(owner)
                        # a copy: a view would keep the whole set
                        tokens.append(found if full else found[: n - need(n) + spare(n)].copy())
                        holders.append(owner)
                        held += len(tokens[-1])
                if held >= HELD_TOKENS:
                    yield from flush(tokens, holders)
                    tokens, holders, seen, held = [], [], set(), 0
            yield record_batch(_SENT, pa.nulls(len(owners), pa.int64()), pa.array(owners, pa.int64()), np.array(sizes, np.int64), batch.column(0))
        yield from flush(tokens, holders)

    return run


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of one token partition to the shared tokens of owners, their lowest bit set for frequent ones."""
    parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for batch in batches:
        documents = batch.column(0).is_null().to_numpy(zero_copy_only=False)
        if documents.any():
            yield batch.filter(pa.array(documents))
            batch = batch.filter(pa.array(~documents))
        token, owner, n = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
        known = n < 0
        if known.any():
            at = int(known.sum())
            yield record_batch(_SENT, token[known] | 1, owner[known], pa.nulls(at, pa.int64()), pa.nulls(at, _DOC))
        parts.append((token[~known], owner[~known], n[~known]))
    if not parts:
        return
    token, owner, n = (np.concatenate(x) for x in zip(*parts, strict=True))
    del parts
    order = np.lexsort((owner, token))
    token, owner, n = token[order], owner[order], n[order]
    if not len(token):
        return
    head = np.r_[True, token[1:] != token[:-1]]
    heads = np.flatnonzero(head)
    # a set that is sent from several batches counts once
    fresh = head | np.r_[True, owner[1:] != owner[:-1]]
    total = np.add.reduceat(np.where(n > 0, n, fresh.astype(np.int64)), heads)
    group = np.cumsum(head) - 1
    keep = (total[group] > 1) & (n == 0) & fresh
    marked = token[keep] | (total[group][keep] >= FREQUENT)
    for at in range(0, len(marked), 1 << 18):
        part = slice(at, at + (1 << 18))
        rows = len(marked[part])
        yield record_batch(_SENT, marked[part], owner[keep][part], pa.nulls(rows, pa.int64()), pa.nulls(rows, _DOC))


def shared_tokens(docs: DataFrame, full: bool, name: str) -> tuple[DataFrame, DataFrame]:
    """(owner, token) for tokens that two owners have, and (doc_id, text_key, owner, n) for each document (doc_id, text)."""
    doc = F.struct(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_key"))
    sent = map_batches(docs.select(doc.alias("doc"), "text"), _send(full), _SENT_DDL)
    route = F.when(F.col("token").isNull(), F.xxhash64("doc.doc_id", "owner", "doc.text_key")).when(F.col("n") < 0, F.xxhash64("owner", "token")).otherwise(F.col("token"))
    got = written(map_batches(sent.repartition(route), _count, _SENT_DDL), name)
    # dealt by owner once: neither this nor a grouping by owner deals them again
    entries = got.where(F.col("token").isNotNull()).select("owner", "token").repartition("owner").dropDuplicates(["owner", "token"])
    return entries, got.where(F.col("token").isNull()).select("doc.doc_id", "doc.text_key", "owner", "n")


# -- keys of owners -------------------------------------------------------------------------------------------------


def bands(n: int) -> list[int]:
    """Size bands of a set of n: its own, and that of the largest set that it can link with."""
    band = lambda x: (x.bit_length() - 1) // 2
    return sorted({band(n), band(4 * n // 3)})


def keys(n: int, tokens: np.ndarray) -> np.ndarray:
    """Index keys of an owner of n tokens, of which ``tokens`` are shared (lowest bit: frequent)."""
    tokens = np.sort(tokens.astype(np.int64).view(np.uint64))
    frequent = (tokens & np.uint64(1)).astype(bool)
    rare, often = tokens[~frequent], tokens[frequent]
    capacity = len(tokens) - need(n) + 1
    if capacity <= 0:
        return np.zeros(0, np.int64)
    out = [rare[:capacity]]
    left = capacity - len(rare)
    if left > 0:
        for band in bands(n):
            classes = max(1, 4**band // 12)
            of = (mix(often ^ np.uint64(0x5851F42D4C957F2D)) % np.uint64(classes)).astype(np.int64)
            first = np.zeros(len(often), bool)
            first[np.unique(of, return_index=True)[1]] = True
            end = int(np.searchsorted(np.cumsum(~first), left)) + 1
            order = np.argsort(of[:end], kind="stable")
            token, of = often[:end][order], of[:end][order]
            for step in range(1, len(token)):
                same = of[step:] == of[:-step]
                if not same.any():
                    break
                out.append(mix(token[:-step][same] * np.uint64(0x9E3779B97F4A7C15) + mix(token[step:][same]) + np.uint64(band)))
    return np.unique(np.concatenate(out)).view(np.int64)


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("key", pa.int64()), ("owner", pa.int64()), ("rank", pa.int64())])
    for batch in batches:
        owner, n = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(2))
        found = [keys(int(a), b.values.to_numpy(zero_copy_only=False)) for a, b in zip(n, batch.column(2), strict=True)]
        sizes = [len(x) for x in found]
        rank = np.array([1_000_000 * len(x) // max(1, int(a)) for a, x in zip(n, batch.column(2), strict=True)], np.int64)
        if found:
            yield record_batch(schema, np.concatenate(found), np.repeat(owner, sizes), np.repeat(rank, sizes))


# -- links of owners ------------------------------------------------------------------------------------------------


def _overlaps(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Intersection sizes of all sets of two lists, by products of 0/1 matrices over slices of the vocabulary.

    If both are one list, the sizes of the sets themselves are not counted in full.
    """
    sizes = [np.array([len(x) for x in side]) for side in (left, right)]
    token = np.concatenate([*left, *right])
    row = np.concatenate([np.repeat(np.arange(len(s)), s) for s in sizes])
    side = np.repeat([0, 1], [int(s.sum()) for s in sizes])
    order = np.argsort(token, kind="stable")
    token, row, side = token[order], row[order], side[order]
    word = np.cumsum(np.r_[False, token[1:] != token[:-1]])
    both = np.zeros(int(word[-1]) + 1 if len(word) else 0, np.int8)
    for s in (0, 1):
        both[word[side == s]] |= 1 << s
    keep = both[word] == 3
    if left is right:  # what only one set has is of no use
        keep &= np.bincount(word)[word] > 2
    row, side, word = row[keep], side[keep], word[keep]
    word = np.cumsum(np.r_[False, word[1:] != word[:-1]]) if len(word) else word
    out = np.zeros((len(left), len(right)), np.float32)
    for start in range(0, int(word[-1]) + 1 if len(word) else 0, _VOCABULARY):
        a, z = np.searchsorted(word, [start, start + _VOCABULARY])
        grids = []
        for s, many in ((0, len(left)), (1, len(right))):
            pick = side[a:z] == s
            grid = np.zeros((many, _VOCABULARY), np.float32)
            grid[row[a:z][pick], word[a:z][pick] - start] = 1
            grids.append(grid)
        out += grids[0] @ grids[1].T
    return out


def _forest(owner: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges from every linked owner to the smallest owner of its part; a, b: positions of linked pairs."""
    label = np.arange(len(owner))
    while True:
        low = np.minimum(label[a], label[b])
        before = label.copy()
        np.minimum.at(label, a, low)
        np.minimum.at(label, b, low)
        label = label[label]
        if (label == before).all():
            break
    moved = np.flatnonzero(label != np.arange(len(owner)))
    return owner[moved], owner[label[moved]]


def _verify(rows: pd.DataFrame) -> pd.DataFrame:
    """Links between the two blocks of a pair, or inside one block, as a spanning forest."""
    rows = rows.sort_values(["side", "owner"])
    side, owner, n = (rows[c].to_numpy() for c in ("side", "owner", "n"))
    sets = [np.asarray(x, np.int64) for x in rows["tokens"]]
    cut = int(np.searchsorted(side, 1))
    left, right = (sets[:cut], sets[cut:]) if cut < len(sets) else (sets, sets)
    size_left, size_right = (n[:cut], n[cut:]) if cut < len(sets) else (n, n)
    both = _overlaps(left, right).astype(np.int64)
    a, b = np.nonzero(100 * both >= 75 * (size_left[:, None] + size_right[None, :] - both))
    b = b + (cut if cut < len(sets) else 0)
    child, root = _forest(owner, a[a != b], b[a != b])
    return pd.DataFrame({"a": child, "b": root})


def _places(core: DataFrame, signed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(owner, block, band) for owners that share a key, and (key, block, band, owners); linked sets' bands are 2 apart at most."""
    hubs = signed.groupBy("key").agg(F.max(F.struct("rank", "owner")).alias("hub"), F.min("owner").alias("low"), F.max("owner").alias("high"))
    hubs = written(hubs.where("low <> high").select("key", "hub"), "hubs")
    met = written(looked_up(signed.select("key", "owner"), "key", hubs).where("hub is not null"), "met")
    family = met.groupBy("owner").agg(F.max("hub").alias("hub")).select("owner", F.col("hub.owner").alias("family"))
    # a band ends at 1.19 times its start; linked sets differ by 1.34 times at most
    band = F.floor(F.lit(4.0) * F.log2("n")).cast("int")
    sized = family.join(core.select("owner", "n", F.size("tokens").alias("m")), "owner").select("owner", "m", band.alias("band"), F.xxhash64("family", band).alias("crowd"))
    sized = written(sized, "sized")
    parts = sized.groupBy("crowd").agg(F.count("*").alias("owners"), F.sum("m").alias("tokens"))
    parts = written(parts.select("crowd", F.greatest(F.ceil(F.col("owners") / BLOCK_OWNERS), F.ceil(F.col("tokens") / BLOCK_TOKENS)).cast("long").alias("parts")), "parts")
    block = F.xxhash64(F.col("crowd"), F.pmod(F.xxhash64(F.lit("part"), F.col("owner")), F.col("parts")))
    placed = written(looked_up(sized, "crowd", parts).select("owner", block.alias("block"), "band"), "blocks")
    spots = written(met.select("key", "owner").join(placed, "owner").groupBy("key", "block", "band").agg(F.count("*").alias("owners")), "spots")
    for table in (hubs, met, sized, parts):
        unwritten(table)
    return placed, spots


def _near(a: str, b: str) -> Column:
    return F.abs(F.col(a) - F.col(b)) <= 2


def _first_meetings(spots: DataFrame) -> DataFrame:
    """(left, right): each block with itself, and with the block that has most owners of one of its keys."""
    inside = spots.where("owners > 1").select(F.col("block").alias("left"), F.col("block").alias("right"))
    most = spots.groupBy("key").agg(F.max(F.struct("owners", "block", "band")).alias("most"), F.count("*").alias("n")).where("n > 1")
    most = written(most.select("key", F.col("most.block").alias("centre"), F.col("most.band").alias("centre_band")), "centres")
    star = looked_up(spots, "key", most).where((F.col("block") != F.col("centre")) & _near("band", "centre_band"))
    return inside.unionByName(star.select(F.least("block", "centre").alias("left"), F.greatest("block", "centre").alias("right"))).distinct()


def _other_meetings(spots: DataFrame, placed: DataFrame, labels: DataFrame, done: DataFrame) -> DataFrame:
    """(left, right) of blocks with a common key that have not met and are not of one and the same group as a whole."""
    named = looked_up(placed, "owner", labels).withColumn("root", F.coalesce("root", "owner"))
    one = F.when(F.min("root") == F.max("root"), F.min("root"))
    whole = written(named.groupBy("block").agg(one.alias("label")), "whole-blocks")
    rows = looked_up(spots.select("key", "block", "band"), "block", whole)
    open_ = (F.count("*") > 1) & ((F.count("label") < F.count("*")) | (F.min("label") != F.max("label")))
    keys = written(rows.groupBy("key").agg(open_.alias("open")).where("open"), "open-keys")
    rows = written(looked_up(rows, "key", keys).where("open").drop("open"), "open-spots")
    a, b = (rows.select("key", *[F.col(c).alias(f"{c}_{side}") for c in ("block", "band", "label")]) for side in "ab")
    apart = F.coalesce(F.col("label_a") != F.col("label_b"), F.lit(True))
    pairs = a.join(b, "key").where((F.col("block_a") < F.col("block_b")) & _near("band_a", "band_b") & apart)
    return pairs.select(F.col("block_a").alias("left"), F.col("block_b").alias("right")).distinct().join(done, ["left", "right"], "left_anti")


def _met(pairs: DataFrame, core: DataFrame, placed: DataFrame) -> DataFrame:
    """Spanning forests (a, b) of the links between the owners of pairs of blocks."""
    first = pairs.select("left", "right", F.lit(0).alias("side"), F.col("left").alias("block"), F.col("right").alias("other"))
    second = pairs.where("left <> right").select("left", "right", F.lit(1).alias("side"), F.col("right").alias("block"), F.col("left").alias("other"))
    sides = written(first.unionByName(second), "sides")
    copies = written(sides.groupBy("block").agg(F.ceil(F.count("*") / MEETINGS).cast("int").alias("copies")).where("copies > 1"), "copies")
    many = F.coalesce("copies", F.lit(1))
    asked = looked_up(sides, "block", copies).withColumn("copy", F.pmod(F.xxhash64("other"), many).cast("int")).drop("copies", "other")
    held = looked_up(core.join(placed, "owner").select("block", "owner", "n", "tokens"), "block", copies)
    held = held.withColumn("copy", F.explode(F.sequence(F.lit(0), many - 1))).drop("copies")
    return asked.join(held, ["block", "copy"]).select("left", "right", "side", "owner", "n", "tokens").groupBy("left", "right").applyInPandas(_verify, "a long, b long")


def grouped(core: DataFrame) -> DataFrame:
    """(owner, root) of linked owners; core: owner, n, tokens."""
    if core.isEmpty():
        return core.select("owner", F.col("owner").alias("root"))
    signed = written(map_batches(core, _sign, "key long, owner long, rank long"), "keys")
    placed, spots = _places(core, signed)
    unwritten(signed)
    first = written(_first_meetings(spots), "first-pairs")
    links = written(_met(first, core, placed), "first-links")
    labels = connected(links)
    rest = written(_other_meetings(spots, placed, labels, first), "other-pairs")
    if rest.isEmpty():
        return labels
    return connected(links.unionByName(_met(rest, core, placed)))


def connected(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(owner, root) for the owners of edges (a, b): root is the smallest owner that links lead to.

    In each round owners take the smallest label of their neighbours, then
    the label of their label; parts of d steps across end in about log d rounds.
    """
    both = written(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    labels = written(both.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("owner"), F.least("a", "b").alias("root")), "labels")
    kept = labels
    if both.isEmpty():
        return labels
    for _ in range(rounds):
        heard = looked_up(both, "b", labels.select(F.col("owner").alias("b"), "root")).select(F.col("a").alias("owner"), "root", F.lit(None).cast("long").alias("own"))
        heard = heard.unionByName(labels.withColumn("own", F.col("root")))
        step = written(heard.groupBy("owner").agg(F.min("root").alias("next"), F.max("own").alias("old")), "steps")
        jumped = looked_up(step, "next", labels.select(F.col("owner").alias("next"), F.col("root").alias("far")))
        after = written(jumped.select("owner", "old", F.least("next", "far").alias("root")), "labels")
        unwritten(step)
        unwritten(kept)
        kept, labels = after, after.select("owner", "root")
        if after.where("old <> root").isEmpty():
            unwritten(both)
            return labels
    raise RuntimeError("labels still change after all rounds")


# -- the operator ---------------------------------------------------------------------------------------------------


def _few(df: DataFrame) -> DataFrame:
    """Broadcast df if its checked number of rows is small; otherwise it is shuffled."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def _size_bound(n: Column) -> Column:
    """min(K_A, K_B) for any B that A can link with: K grows with the size, and |B| >= ceil(0.75 |A|)."""
    least = F.floor((75 * n + 99) / 100)
    return F.when(least >= 24, F.floor(least / 12)).otherwise(1)


def components(docs: DataFrame) -> DataFrame:
    """(doc_id, text_key, n, root) of every row of docs (doc_id, text), a written table: root is null for empty sets.

    text_key is xxhash64 of the text: with doc_id it tells which row this is.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    entries, documents = shared_tokens(docs, False, "prefix-tokens")
    owners = documents.where(F.col("owner").isNotNull()).groupBy("owner").agg(F.min("doc_id").alias("doc_id"), F.max("n").alias("n"))
    counts = entries.groupBy("owner").agg(F.count("*").alias("m"))
    alive = written(counts.join(owners, "owner").where(F.col("m") >= _size_bound(F.col("n"))).select("owner", "n", "doc_id"), "sifted")
    # whole texts are read again by the smallest id that they stand under; sets that only rows without an id hold, from all such rows
    some = docs.join(_few(alive.where("doc_id is not null").select("doc_id").distinct()), "doc_id", "left_semi")
    if not alive.where("doc_id is null").isEmpty():
        some = some.unionByName(docs.where("doc_id is null"))
    entries, _ = shared_tokens(some, True, "full-tokens")
    sets = entries.groupBy("owner").agg(F.collect_list("token").alias("tokens"))
    core = written(sets.join(alive.select("owner", "n"), "owner").where(F.size("tokens") >= F.floor((75 * F.col("n") + 99) / 100)).select("owner", "n", "tokens"), "core")
    roots = grouped(core)
    return written(looked_up(documents, "owner", roots).select("doc_id", "text_key", "n", F.coalesce("root", "owner").alias("root")), "components")


def groups(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every document."""
    named = components(docs)
    names = named.where(F.col("root").isNotNull()).groupBy("root").agg(F.min("doc_id").alias("component_id"), F.count("*").alias("members")).where("members > 1").drop("members")
    return looked_up(named, "root", written(names, "names")).select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"))


def oracle() -> str:
    """DuckDB SQL for the rows of ``groups``: all pairs that share a shingle, then reachability.  For small tables."""
    return """
WITH RECURSIVE
docs AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
sets AS MATERIALIZED (SELECT r, doc_id, CASE WHEN len(w) >= 5 THEN list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END AS s FROM docs),
sized AS MATERIALIZED (SELECT r, doc_id, len(s)::BIGINT AS n FROM sets),
tokens AS MATERIALIZED (SELECT r, unnest(s) AS t FROM sets),
pairs AS (SELECT a.r AS a, b.r AS b, count(*) AS k FROM tokens a JOIN tokens b ON a.t = b.t AND a.r <> b.r GROUP BY 1, 2),
links AS MATERIALIZED (SELECT a, b FROM pairs JOIN sized x ON x.r = a JOIN sized y ON y.r = b WHERE 100 * k >= 75 * (x.n + y.n - k)),
reach AS (SELECT r AS r, r AS root FROM sized UNION SELECT l.b, reach.root FROM reach JOIN links l ON l.a = reach.r)
SELECT doc_id, n AS n_shingles, component_id FROM sized JOIN (SELECT reach.r, min(o.doc_id) AS component_id FROM reach JOIN sized o ON o.r = reach.root GROUP BY 1) USING (r)"""


def keep_one(docs: DataFrame) -> DataFrame:
    """One row of each group of docs, with its own columns; rows with an empty set all stay.

    The row with the smallest doc_id stays, one without an id only where none
    of the group has one; of several texts under that doc_id the one with the
    smallest hash; of rows equal in doc_id and text one, no matter which.
    Rows of another group stay, even if they have a doc_id that goes here.
    """
    found = components(docs).where(F.col("root").isNotNull())
    me = F.struct(F.col("doc_id").isNull().alias("late"), "doc_id", "text_key")
    best = written(found.groupBy("root").agg(F.min(me).alias("best"), F.count("*").alias("members")).where("members > 1").select("root", "best"), "best")
    judged = looked_up(found, "root", best).where("best is not null").withColumn("stays", me == F.col("best"))
    judged = written(judged.groupBy("doc_id", "text_key").agg(F.max("stays").alias("stays"), F.count("*").alias("times")), "judged")
    key, doc = private(docs, "text_key", "doc")
    keyed = docs.withColumns({key: F.xxhash64("text"), doc: F.col("doc_id").cast("long")})

    def among(rows: DataFrame, listed: DataFrame, how: str) -> DataFrame:
        return rows.join(_few(listed), rows[doc].eqNullSafe(listed["doc_id"]) & (rows[key] == listed["text_key"]), how)

    kept = among(keyed, judged.where("not stays"), "left_anti")
    repeated = judged.where("stays and times > 1")
    if repeated.isEmpty():
        return kept.select(*docs.columns)
    whole = F.first(F.struct(*docs.columns)).alias(key)
    once = among(kept, repeated, "left_semi").groupBy(F.col(doc).alias("doc"), F.col(key).alias("text")).agg(whole).select(f"{key}.*")
    return among(kept, repeated, "left_anti").select(*docs.columns).unionByName(once)
