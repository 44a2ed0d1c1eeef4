"""Benchmark decontamination by q-gram lemma filtering and banded alignment.

Texts and benchmark items are normalized character by character: lower case,
each white space a space.  A document holds a passage of an item if one of the
item's windows of ``WINDOW`` characters, wherever it starts, stands in it with
at most e = floor(RATE * WINDOW) edits; so each verbatim part of ``WINDOW``
characters or more is found.  Items shorter than a window are one window with
floor(RATE * length) edits, as far as the lemma's bound stays positive: 1 from
16 characters on, none below 13.  Items shorter than a q-gram are found where
they stand as they are, with no letter or digit next to them.

By the q-gram lemma, a place with at most e edits shares L - q + 1 - q * e
q-grams with a window of L characters, all on diagonals (place in the text
less place in the item) that are at most e apart.

1. The q-grams of every text are looked up among the benchmark's.
2. Stretches of text with fewer hits than any window's bound are dropped.
3. In what is left, hits are sorted by item, diagonal band and place in the
   item; bands are 2e wide and overlap by half, so that each place lies in one
   as a whole.  For every window, the hits of a band are counted.
   Windows of an item that are equal are looked for once, so that runs of one
   character or of a short period have few places; of long runs of one
   character in a text only both ends are looked at, as every place in between
   is like them; hits are spelled out in stretches of about ``HITS``.
4. Windows that meet their bound are verified: edit distance to the text,
   its start and end free, over the band's diagonals and e more on either side.
   The alignment remembers where it starts.

The benchmark is a query set: it is broadcast in blocks of at most
``BLOCK_GRAMS`` characters, some 16 bytes for each, one pass over the documents
for each block.

Defined cases: null texts hold no passage; null items have no window; items
repeated under several ids are all reported; positions are characters (code
points) of the text; repeated document rows are reported each; long texts are
looked at in overlapping pieces; other columns are ignored by ``find`` and kept
by ``clean``.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import cached_property

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import SLICE_BYTES, map_batches, text_slices

Q = 8
WINDOW = 48
RATE = 0.08
BLOCK_GRAMS = 1 << 19
#: Characters of a long run that are looked at on either side: more than any window with its edits.
RUN = 128
#: Bytes by which pieces of a long text overlap: more than any window with its edits, in UTF-8.
OVERLAP = 1024
_BITS = 22
_BASE, _SPREAD = 0x100000001B3, np.uint64(0x9E3779B97F4A7C15)
_NOTHING = np.uint32(0xFFFFFFFF)
#: Windows that are aligned at once, and pairs of places that are looked at together.
_LOT, HITS = 4096, 1 << 18
_UNIT = 1 << 16
#: A multiple of all widths of bands.
_WIDTHS = math.lcm(*range(1, int(RATE * WINDOW) + 1))

_tables: dict[str, np.ndarray] = {}


def _lower() -> np.ndarray:
    """The normal form of each character of the basic plane that has one of length 1."""
    if "lower" not in _tables:
        table = np.arange(1 << 16, dtype=np.uint32)
        for c in map(chr, range(1 << 16)):
            low = " " if c.isspace() else "σ" if c == "ς" else c.lower()
            if len(low) == 1:
                table[ord(c)] = ord(low)
        _tables["lower"] = table
    return _tables["lower"]


def normalized(data: bytes) -> np.ndarray:
    """Code points of a UTF-8 text in normal form, as many as the text has."""
    points = np.frombuffer(data.decode("utf-8", "replace").encode("utf-32-le", "replace"), np.uint32)
    low = _lower()[np.minimum(points, 0xFFFF)]
    return np.where(points > 0xFFFF, points, low)


def qgrams(points: np.ndarray) -> np.ndarray:
    """A 64-bit number of the Q = 8 characters from each place on: a polynomial, by doubling."""
    if len(points) < Q:
        return np.zeros(0, np.uint64)
    h, power = points.astype(np.uint64), _BASE
    for step in (1, 2, 4):
        h = h[:-step] * np.uint64(power) + h[step:]
        power = power * power % (1 << 64)
    return h


def edits_of(length):
    """Edits that a window of an item of some length may have: fewer where no q-gram would have to be shared."""
    size = np.minimum(np.asarray(length), WINDOW)
    return np.minimum(np.floor(RATE * size), np.maximum(0, (size - Q) // Q)).astype(np.int64)


class Index:
    """The q-grams of items whose windows are of about one length, by their number, with their places."""

    def __init__(self, items: list[tuple[int, np.ndarray]]):
        size = np.array([len(x) for _, x in items], np.int64)
        self.item = np.array([k for k, _ in items], np.int64)
        self.text = np.concatenate([x for _, x in items])
        self.start = np.cumsum(np.r_[0, size[:-1]])
        self.length = np.minimum(size, WINDOW)
        self.edits = edits_of(size)
        self.bound = np.maximum(1, self.length - Q + 1 - Q * self.edits)
        grams = qgrams(self.text)
        #: starts of the windows that differ, and how many there are of each
        self.window, self.weight = self._windows(grams, size)
        self.last = self.start + size - self.length  # where an item's last window starts
        used = np.zeros(len(self.text) + 1, np.int64)
        own = np.searchsorted(self.start, self.window, side="right") - 1
        np.add.at(used, self.window, 1)
        np.add.at(used, self.window + self.length[own] - Q + 1, -1)
        place = np.flatnonzero(np.cumsum(used) > 0)
        gram = grams[place]
        order = np.argsort(gram, kind="stable")
        self.place = place[order].astype(np.int32)
        self.gram, self.first = np.unique(gram[order], return_index=True)
        #: what a stretch of ``reach`` places must have at least
        self.least, self.reach = int(self.bound.min()), int((self.length + self.edits).max())

    def _windows(self, grams: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The first of all equal windows of each item, and their numbers: windows are equal if their q-grams are."""
        power = np.multiply.accumulate(np.r_[np.uint64(1), np.full(len(grams), _BASE, np.uint64)])
        total = np.r_[np.uint64(0), np.cumsum(grams * power[:-1])]
        inverse = np.multiply.accumulate(np.r_[np.uint64(1), np.full(len(grams), pow(_BASE, -1, 1 << 64), np.uint64)])
        first, weight = [], []
        for a, n, length in zip(self.start.tolist(), size.tolist(), self.length.tolist(), strict=True):
            at = np.arange(a, a + n - length + 1)
            _, one, many = np.unique((total[at + length - Q + 1] - total[at]) * inverse[at], return_index=True, return_counts=True)
            order = np.argsort(one)
            first.append(at[one[order]])
            weight.append(many[order])
        return np.concatenate(first), np.concatenate(weight)

    def known(self, gram: np.ndarray) -> np.ndarray:
        """Whether q-grams may be among those of the items (a filter of one hash)."""
        if not hasattr(self, "filter"):
            self.filter = np.zeros(1 << _BITS, bool)
            self.filter[((self.gram * _SPREAD) >> np.uint64(64 - _BITS)).astype(np.intp)] = True
        return self.filter[((gram * _SPREAD) >> np.uint64(64 - _BITS)).astype(np.intp)]

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k != "filter"}


class Tiny:
    """Items shorter than a q-gram, found by an automaton."""

    def __init__(self, items: dict[str, list[int]]):
        self.items = items

    def __getstate__(self) -> dict:
        return {"items": self.items}

    @cached_property
    def automaton(self) -> ahocorasick.Automaton:
        out = ahocorasick.Automaton(ahocorasick.STORE_LENGTH)
        for text in self.items:
            out.add_word(text)
        out.make_automaton()
        return out

    def found(self, points: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
        """(document, item, start, end) where an item stands by itself."""
        text = points.tobytes().decode("utf-32-le", "replace")
        for end, length in self.automaton.iter(text):
            start, end = end - length + 1, end + 1
            doc = int(np.searchsorted(offsets, start, side="right")) - 1
            a, z = int(offsets[doc]), int(offsets[doc + 1])
            if end <= z and not (start > a and text[start - 1].isalnum()) and not (end < z and text[end].isalnum()):
                for item in self.items[text[start:end]]:
                    yield doc, item, start - a, end - a


def indexes(items: list[tuple[int, str]]) -> tuple[list[Index], Tiny]:
    """Indexes by length class (short windows with low bounds don't weaken the filter for full ones), and the shortest items by text."""
    classes: dict[int, list[tuple[int, np.ndarray]]] = {}
    tiny: dict[str, list[int]] = {}
    for item, text in items:
        points = normalized(text.encode("utf-8", "replace"))
        if len(points) >= Q:
            classes.setdefault(min(len(points), WINDOW) // 16, []).append((item, points))
        elif bare := points.tobytes().decode("utf-32-le", "replace").strip(" "):
            tiny.setdefault(bare, []).append(item)
    return [Index(x) for x in classes.values()], Tiny(tiny)


def hits(gram: np.ndarray, p: Index) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(place in the text, first of its q-gram's places in the index, number of those) of shared q-grams in stretches that have enough of them."""
    maybe = p.known(gram)
    total = np.zeros(len(maybe) + 1, np.int64)
    np.cumsum(maybe, out=total[1:])
    none = np.zeros(0, np.int64)
    if total[-1] < p.least:
        return none, none, none
    ahead = np.minimum(np.arange(len(maybe)) + p.reach, len(maybe))
    dense = np.flatnonzero(total[ahead] - total[:-1] >= p.least)
    if not len(dense):
        return none, none, none
    mark = np.bincount(dense, minlength=len(maybe) + 1) - np.bincount(np.minimum(dense + p.reach, len(maybe)), minlength=len(maybe) + 1)
    spots = np.flatnonzero(maybe & (np.cumsum(mark[:-1]) > 0))
    at = np.minimum(np.searchsorted(p.gram, gram[spots]), len(p.gram) - 1)
    true = p.gram[at] == gram[spots]
    spots, at = spots[true], at[true]
    return spots, p.first[at], np.r_[p.first[1:], len(p.place)][at] - p.first[at]


def stretches(spots: np.ndarray, many: np.ndarray, reach: int) -> Iterator[slice]:
    """Parts of the spots with about ``HITS`` places each; a part begins ``reach`` before the last one's end, so that no window is cut."""
    total, start = np.cumsum(many), 0
    while start < len(spots):
        end = int(np.searchsorted(total, total[start] - many[start] + HITS, side="right"))
        if end >= len(spots):
            yield slice(start, len(spots))
            return
        # the next part must begin further on than this one
        end = max(end, int(np.searchsorted(spots, spots[start] + 2 * reach)))
        yield slice(start, end)
        start = int(np.searchsorted(spots, spots[end - 1] - reach)) if end < len(spots) else end


def _weights(n: int) -> np.ndarray:
    """Odd factors that tell rows of n numbers apart by their sum."""
    if "weights" not in _tables or len(_tables["weights"]) < n:
        _tables["weights"] = np.random.default_rng(1).integers(0, 1 << 63, max(n, 128), np.uint64) * np.uint64(2) + np.uint64(1)
    return _tables["weights"][:n]


def aligned(text: np.ndarray, pattern: np.ndarray, e: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(edits, start, end) of each pattern's best place in its stretch of text, within the band of diagonals.

    text has a row of len(pattern) + width - 1 characters for each pattern; a
    place on diagonal d starts at text[d].  Of equal places the one that starts
    last and then ends first is taken.
    """
    n, length = pattern.shape
    width = text.shape[1] - length + 1
    steps = np.arange(width, dtype=np.int64)
    # the cost, and below it how far the start is from the last diagonal
    row = np.tile(width - 1 - steps, (n, 1))
    for i in range(length):
        moved = row + (text[:, i : i + width] != pattern[:, i, None]) * _UNIT
        moved[:, :-1] = np.minimum(moved[:, :-1], row[:, 1:] + _UNIT)
        row = np.minimum.accumulate(moved - steps * _UNIT, axis=1) + steps * _UNIT
    end = row.argmin(axis=1)
    best = row[np.arange(n), end]
    return best // _UNIT, width - 1 - best % _UNIT, end + length


def windows(points: np.ndarray, offsets: np.ndarray, p: Index) -> np.ndarray:
    """Rows (document, item's number, window's start in the index, start, end, edits) of all windows found in several texts."""
    out = [np.zeros((0, 6), np.int64)]
    spots, first, many = hits(qgrams(points), p)
    for part in stretches(spots, many, 2 * p.reach):
        n = many[part]
        flat = np.repeat(first[part] - np.cumsum(n) + n, n) + np.arange(int(n.sum()))
        out.append(_windows(points, offsets, p, np.repeat(spots[part], n), p.place[flat].astype(np.int64)))
    return np.concatenate(out)


def _windows(points: np.ndarray, offsets: np.ndarray, p: Index, at: np.ndarray, place: np.ndarray) -> np.ndarray:
    empty = np.zeros((0, 6), np.int64)
    doc = np.searchsorted(offsets, at, side="right") - 1
    whole = at + Q <= offsets[doc + 1] if len(at) else np.zeros(0, bool)  # no q-gram of two documents
    at, place, doc = at[whole], place[whole], doc[whole]
    if len(at) < p.least:
        return empty
    item = np.searchsorted(p.start, place, side="right") - 1
    wide = np.maximum(1, p.edits[item])
    band = (at - place + len(p.text)) // wide
    bands = len(points) + len(p.text) + 2
    group = np.concatenate([(doc * len(p.item) + item) * bands + band + 1, (doc * len(p.item) + item) * bands + band])
    group, rank = np.unique(group, return_inverse=True)
    span = len(p.text) + 1
    found = np.sort(rank * span + np.tile(place, 2))
    found = found[np.r_[True, found[1:] != found[:-1]]]  # a place of the item counts once in a band
    rank, place = found // span, found % span
    item = group[rank] // bands % len(p.item)
    # a window meets its bound if it holds so many hits in a row: it starts at the first of them at the latest
    end = np.arange(len(found)) + p.bound[item] - 1
    ok = end < len(found)
    ok[ok] = rank[end[ok]] == rank[ok]
    rank, place, item, end = rank[ok], place[ok], item[ok], found[end[ok]] % span
    low, high = np.maximum(end - (p.length[item] - Q), p.start[item]), np.minimum(place, p.last[item])
    # both grow within a band: each start is taken from the first hits that allow it
    before = np.r_[-1, np.where(rank[1:] == rank[:-1], np.maximum.accumulate(rank * span + high)[:-1] - rank[1:] * span, -1)][: len(rank)]
    low = np.maximum(low, before + 1)
    low, high = np.searchsorted(p.window, low), np.searchsorted(p.window, high, side="right")
    many = np.maximum(0, high - low)
    if not many.any():
        return empty
    rank, start = np.repeat(rank, many), p.window[np.repeat(low - np.cumsum(many) + many, many) + np.arange(int(many.sum()))]
    doc, item, band = group[rank] // bands // len(p.item), group[rank] // bands % len(p.item), group[rank] % bands - 1
    out = []
    for length, e in {*zip(p.length[item].tolist(), p.edits[item].tolist(), strict=True)}:
        own = np.flatnonzero((p.length[item] == length) & (p.edits[item] == e))
        wide = max(1, e)
        width = 2 * wide + 2 * e
        for lot in np.split(own, range(_LOT, len(own), _LOT)):
            base = start[lot] + band[lot] * wide - len(p.text) - e  # where the band's first diagonal meets the text
            spot = base[:, None] + np.arange(length + width - 1)
            inside = (spot >= offsets[doc[lot]][:, None]) & (spot < offsets[doc[lot] + 1][:, None])
            text = np.where(inside, points[np.clip(spot, 0, len(points) - 1)], _NOTHING)
            # repeated texts have equal stretches for equal windows: each pair is aligned once
            _, one, same = np.unique((text.astype(np.uint64) * _weights(text.shape[1])).sum(axis=1) + start[lot].astype(np.uint64) * _SPREAD, return_index=True, return_inverse=True)
            edits, a, z = (x[same] for x in aligned(text[one], p.text[start[lot][one][:, None] + np.arange(length)], e))
            ok = edits <= e
            a, z = (np.clip(base + x, offsets[doc[lot]], offsets[doc[lot] + 1]) - offsets[doc[lot]] for x in (a, z))
            out.append(np.stack([doc[lot], item[lot], start[lot], a, z, edits], axis=1)[ok])
    return np.concatenate(out)


def merged(found: list[tuple[int, int, int, int, int, int]]) -> list[tuple[int, int, int, int, int]]:
    """(item, start, end, fewest edits, windows): overlapping places of one item's windows in one text become one passage.

    found are (item, start, end, edits, window, how many windows are equal to it).
    """
    out: list[list] = []
    for item, start, end, edits, window, weight in sorted(found):
        if out and out[-1][0] == item and start <= out[-1][2]:
            out[-1][2] = max(out[-1][2], end)
            out[-1][3] = min(out[-1][3], edits)
            out[-1][4][window] = weight
        else:
            out.append([item, start, end, edits, {window: weight}])
    return [(*x[:4], sum(x[4].values())) for x in out]


def _pieces(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray, int]]:
    """(first row, offsets, code points, code points of the row before these): texts of a slice, or an overlapping piece of a long one."""
    for first, offsets, data in text_slices(column):
        if len(offsets) > 2 or len(data) <= 2 * SLICE_BYTES:
            heads = np.zeros(len(data) + 1, np.int64)
            np.cumsum((data & 0xC0) != 0x80, out=heads[1:])
            yield first, heads[offsets], normalized(data.tobytes()), 0
            continue
        at = before = 0
        edge = lambda x, data=data: next(y for y in range(x, len(data) + 1) if y == len(data) or data[y] & 0xC0 != 0x80)
        while True:
            points = normalized(data[at : edge(min(len(data), at + SLICE_BYTES + OVERLAP))].tobytes())
            yield first, np.array([0, len(points)]), points, before
            after = edge(min(len(data), at + SLICE_BYTES))
            if after + OVERLAP >= len(data):
                break
            before += int(((data[at:after] & 0xC0) != 0x80).sum())
            at = after


def shortened(points: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray | None]:
    """Texts without the inner part of long runs of one character, their offsets, and where each character that is left stood.

    What is left on either side is longer than any window with its edits, so a
    window that lies across the gap stands at each place of the run.
    """
    edge = np.ones(len(points) + 1, bool)
    edge[1:-1] = points[1:] != points[:-1]
    edge[offsets] = True
    edges = np.flatnonzero(edge)
    long = np.flatnonzero(np.diff(edges) > 2 * RUN)
    if not len(long):
        return points, offsets, None
    left = np.ones(len(points), bool)
    for i in long.tolist():
        out = int(edges[i + 1] - edges[i]) - 2 * RUN
        # what is left keeps its place in the bands, whatever their width
        left[edges[i] + RUN : edges[i] + RUN + out - out % _WIDTHS] = False
    origin = np.flatnonzero(left)
    return points[origin], np.searchsorted(origin, offsets), origin


def passages(column: pa.Array, known: list[Index], tiny: Tiny) -> list[list[tuple[int, int, int, int, int]]]:
    """The merged passages of each text of a column."""
    found: list[list] = [[] for _ in range(len(column))]
    for first, own_offsets, own_points, before in _pieces(column):
        points, offsets, origin = shortened(own_points, own_offsets)
        for p in known:
            rows = windows(points, offsets, p)
            if origin is not None and len(rows):
                doc, at = rows[:, 0], offsets[rows[:, 0]]
                rows[:, 3], rows[:, 4] = origin[np.minimum(at + rows[:, 3], len(origin) - 1)] - own_offsets[doc], origin[at + np.maximum(rows[:, 4], 1) - 1] + 1 - own_offsets[doc]
            weight = p.weight[np.searchsorted(p.window, rows[:, 2])].tolist()
            for (doc, item, window, a, z, edits), n in zip(rows.tolist(), weight, strict=True):
                found[first + doc].append((int(p.item[item]), before + a, before + z, edits, window, n))
        if tiny.items:
            for doc, item, a, z in tiny.found(own_points, own_offsets):
                found[first + doc].append((item, before + a, before + z, 0, 0, 1))
    return [merged(x) for x in found]


def blocks(benchmark: DataFrame) -> Iterator[list[tuple[int, str]]]:
    """The benchmark's items in blocks of bounded size."""
    items = benchmark.where(F.col("text").isNotNull() & F.col("item_id").isNotNull()).select(F.col("item_id").cast("long").alias("item_id"), "text")
    size = items.agg(F.sum(F.length("text")).alias("n")).first()["n"] or 0
    count = max(1, -(-size // BLOCK_GRAMS))
    for k in range(count):
        rows = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(count)) == k).collect()
        if rows:
            yield sorted((r["item_id"], r["text"]) for r in rows)


def _scan(docs: DataFrame, items: list[tuple[int, str]], each, schema) -> DataFrame:
    """mapInArrow over docs; each(batch, found) makes the output from the passages of every row of the batch."""
    shared = docs.sparkSession.sparkContext.broadcast(indexes(items))
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield each(batch, passages(batch.column(at), *shared.value))

    return map_batches(docs, run, schema)


def find(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, start, end, edits, windows) of every benchmark passage in every document.

    edits are the fewest of any of the passage's windows; windows is how many of the item's windows it has.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("start", pa.int64()), ("end", pa.int64()), ("edits", pa.int32()), ("windows", pa.int32())])

    def each(batch: pa.RecordBatch, found: list) -> pa.RecordBatch:
        rows = [(i, *x) for i, own in zip(batch.column(0).to_pylist(), found, strict=True) for x in own]
        columns = list(zip(*rows, strict=True)) or [()] * 6
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    ddl = "doc_id long, item_id long, start long, end long, edits int, windows int"
    out = None
    for items in blocks(benchmark):
        part = _scan(narrow, items, each, ddl)
        out = part if out is None else out.unionByName(part)
    return docs.sparkSession.createDataFrame([], ddl) if out is None else out


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """docs without the documents that hold a benchmark passage."""
    for items in blocks(benchmark):
        docs = _scan(docs, items, lambda batch, found: batch.filter(pa.array([not x for x in found], pa.bool_())), docs.schema)
    return docs
