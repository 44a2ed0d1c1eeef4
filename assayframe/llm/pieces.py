"""SentencePiece BPE encoding and decoding by a table of prefixes and their last tokens.

A prefix of a text has one encoding, and that has one last token.  The table
of last tokens is filled from left to right: an automaton, a trie of the pieces
that is walked from all places at once, finds all that end at a place, and the
one is taken that is compatible with the last token of
the prefix before it, which means that the merges turn the two tokens' joined
text into just these two.  An encoding is right if all its neighbours are
compatible, so no text is ever merged as a whole: the ids are read from the
table backwards.  Merging is done for pieces and pairs of pieces only, and
remembered.

Merges take the neighbours whose joined text is the piece of the best score,
leftmost first.  Characters that are no piece become bytes.  White space is
written as U+2581, one is put in front of a text that isn't empty, and decoding
takes it away again.  Texts are cut where no piece can lie across: before a
run of U+2581, and around characters that stand in no longer piece.  These
chunks repeat, so each worker keeps a bounded number of their encodings.

The model is read on the driver by the public library (its pieces and scores
are some hundred kilobytes and travel as a broadcast); encoding and decoding
don't use the library.  Models of another kind (normalization, pieces given by
the user, suffix white space) are told by a few probes and refused.

Defined cases: null and empty texts have no tokens and decode to an empty text;
repeated rows give repeated results; long texts are encoded chunk by chunk, and
``digest`` never holds a text's ids; ``encode`` and ``decode`` keep all other
columns and replace one with the name of the one they add; null ids decode to
an empty text, ids without a piece raise an error; an empty table stays empty.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import cached_property
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import map_batches

SPACE = "▁"
#: Encodings of chunks, and verdicts on pairs, that a worker keeps at most; then it starts anew.
KEPT = 1_000_000
#: Characters of a chunk that is kept.
KEPT_CHARS = 48
#: Characters of text that are looked at together, and of new chunks whose tables are filled together.
LOT, NEW = 1 << 20, 1 << 17
#: Places of the table of verdicts that numpy looks up, a power of 2.
_SEATS = 1 << 20
_STRETCH = 1 << 14
_UNKNOWN = -2
#: Texts whose encoding and decoding tell a model of another kind.
PROBES = ("", " ", "  a", "a  ", "▁a", "ﬁ Å", "<s> </s> <0x41> <unk>", "a\nb\t1\r\n", "\u0001\U0001f9ff", "é ẛ̣", "           x")


class Automaton:
    """A trie of pieces that is walked from many places of a text at once.

    A step is looked up by a hash of (node, character); the few steps whose
    seat is taken by another are looked up in a sorted table.
    """

    def __init__(self, words: dict[str, int]):
        self.longest = max(map(len, words))
        self.code = np.zeros(0x110000, np.int64)
        used = sorted({c for x in words for c in x})
        self.code[[ord(c) for c in used]] = np.arange(1, len(used) + 1)
        self.width = len(used) + 1
        steps: dict[tuple[int, str], int] = {}
        ends = {}
        for text, number in words.items():
            node = 0
            for c in text:
                node = steps.setdefault((node, c), len(steps) + 1)
            ends[node] = number
        self.word = np.full(len(steps) + 1, -1, np.int64)
        self.word[list(ends)] = list(ends.values())
        key = np.array([node * self.width + int(self.code[ord(c)]) for node, c in steps], np.int64)
        order = np.argsort(key)
        self.rest_key, self.rest_node = key[order], np.arange(1, len(steps) + 1)[order]
        seat = _seat(self.rest_key)
        self.key, self.node = np.full(_SEATS, -1, np.int64), np.zeros(_SEATS, np.int64)
        self.key[seat], self.node[seat] = self.rest_key, self.rest_node
        moved = self.key[seat] != self.rest_key
        self.full = np.zeros(_SEATS, bool)
        self.full[seat[moved]] = True
        self.rest_key, self.rest_node = self.rest_key[moved], self.rest_node[moved]

    def found(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(start, end, number) of all words in a text."""
        code = np.append(self.code[np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)], 0)
        start, node = np.arange(len(code) - 1), np.zeros(len(code) - 1, np.int64)
        out = []
        for depth in range(self.longest):
            key = node * self.width + code[start + depth]
            seat = _seat(key)
            node = np.where(self.key[seat] == key, self.node[seat], 0)
            other = np.flatnonzero(self.full[seat] & (node == 0))
            if len(other):
                at = np.minimum(np.searchsorted(self.rest_key, key[other]), len(self.rest_key) - 1)
                node[other] = np.where(self.rest_key[at] == key[other], self.rest_node[at], 0)
            alive = np.flatnonzero(node)
            start, node = start[alive], node[alive]
            number = self.word[node]
            own = np.flatnonzero(number >= 0)
            out.append((start[own], start[own] + depth + 1, number[own]))
            inside = start + depth + 1 < len(code)
            start, node = start[inside], node[inside]
        first, end, number = (np.concatenate(x) for x in zip(*out, strict=True))
        return first, end, number

    def by_end(self, text: str) -> Iterator[tuple[int, int]]:
        """(end, number) of all words in a text, ordered by end, some thousand characters at a time."""
        for at in range(0, len(text), _STRETCH):
            lead = max(0, at - self.longest)
            _, end, number = self.found(text[lead : at + _STRETCH])
            own = np.flatnonzero(end + lead > at)
            own = own[np.argsort(end[own], kind="stable")]
            yield from zip((end[own] + lead).tolist(), number[own].tolist(), strict=True)


def _seat(key: np.ndarray) -> np.ndarray:
    return ((key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(44)).astype(np.int64) % _SEATS


@dataclass
class Model:
    """Pieces that merges can make, by text: (id, score); the ids of bytes; texts of all ids (None: a control piece)."""

    pieces: dict[str, tuple[int, float]]
    byte_ids: list[int]
    texts: list[bytes | None]

    def __getstate__(self) -> dict:
        return {k: self.__dict__[k] for k in ("pieces", "byte_ids", "texts")}

    def __post_init__(self) -> None:
        # a piece that merges don't make from its own text is in no encoding
        self.pieces = {x: v for x, v in self.pieces.items() if len(x) == 1 or self.merged(x) == [x]}

    def merged(self, text: str, least: int = 1) -> list[str]:
        """The pieces that merging makes of a short text, or what stands before the merge that leaves fewer than ``least``."""
        out, pieces = list(text), self.pieces
        while len(out) > least:
            best = at = None
            for i in range(len(out) - 1):
                found = pieces.get(out[i] + out[i + 1])
                if found is not None and (best is None or found[1] > best):
                    best, at = found[1], i
            if at is None:
                break
            out[at : at + 2] = [out[at] + out[at + 1]]
        return out

    @cached_property
    def made(self) -> dict[int, tuple[int, int, int]]:
        """(when, of which first, of which last) each piece is made: its place by score; -1 for single characters.

        Left out are pieces with equal scores, or that are better than one of their parts.
        """
        order = sorted(((number, score, text) for text, (number, score) in self.pieces.items()), key=lambda x: -x[1])
        scores = Counter(x[1] for x in order)
        out: dict[int, tuple[int, int, int]] = {}
        for when, (number, score, text) in enumerate(order):
            if len(text) == 1:
                out[number] = (-1, number, number)
            elif scores[score] == 1:
                first, last = (self.pieces[x] for x in self.merged(text, 2))
                if all(len(self.names[x[0]]) == 1 or x[1] > score for x in (first, last)):
                    out[number] = (when, first[0], last[0])
        return out

    @cached_property
    def automaton(self) -> Automaton:
        return Automaton({text: number for text, (number, _) in self.pieces.items()})

    @cached_property
    def names(self) -> dict[int, str]:
        return {number: text for text, (number, _) in self.pieces.items()}

    @cached_property
    def chunk(self) -> re.Pattern:
        """Chunks that no piece passes: runs of white space with what follows, single characters that stand in no longer piece."""
        longer = [x for x in self.pieces if len(x) > 1]
        if any(a != SPACE and b == SPACE for x in longer for a, b in zip(x, x[1:], strict=False)):
            return re.compile(r".+", re.DOTALL)
        lone = re.escape("".join(map(chr, sorted(set(range(128)) - {ord(c) for x in longer for c in x}))))
        return re.compile(f"{SPACE}+[^{SPACE}{lone}]*|[{lone}]|[^{SPACE}{lone}]+")

    @cached_property
    def verdicts(self) -> dict[int, bool]:
        return {}

    @cached_property
    def seats(self) -> np.ndarray:
        """Verdicts by a hash of their pair: twice the pair's key, and one more where it is compatible."""
        return np.full(_SEATS, -1, np.int64)

    @cached_property
    def sizes(self) -> np.ndarray:
        out = np.ones(len(self.texts), np.int64)
        for number, text in self.names.items():
            out[number] = len(text)
        return out

    @cached_property
    def numerals(self) -> list[bytes]:
        return [str(x).encode() for x in range(len(self.texts))]

    @cached_property
    def plain(self) -> list[bytes | None]:
        """The texts of pieces that are no bytes."""
        return [None if x in self._bytes else text or b"" for x, text in enumerate(self.texts)]

    @cached_property
    def between(self) -> str:
        """A character that stands in no piece."""
        used = {c for x in self.pieces for c in x}
        return next(c for c in map(chr, range(1 << 16)) if c not in used)

    @cached_property
    def kept(self) -> dict[str, tuple[int, bytes, bytes]]:
        """(number of ids, ids joined by commas, text that they decode to) of chunks."""
        return {}

    def compatible(self, before: int, after: int) -> bool:
        key = before << 16 | after
        found = self.verdicts.get(key)
        if found is None:
            found = self._stays(before, after)
            if len(self.verdicts) >= KEPT:
                self.verdicts.clear()
            self.verdicts[key] = found
        return found

    def _stays(self, before: int, after: int) -> bool:
        """Whether no merge across the border of two tokens comes first, going back through their own merges."""
        names, pieces, made = self.names, self.pieces, self.made
        whole = [names[before], names[after]]
        gone_before = gone_after = len(pieces)  # when the two parts at the border are merged into longer ones
        while True:
            across = pieces.get(names[before] + names[after])
            if before not in made or after not in made or (across and across[0] not in made):
                return self.merged("".join(whole)) == whole
            if across is not None:
                when = made[across[0]][0]
                # of equal ones the leftmost is first: that within the first token, then that across
                if when < gone_before and when <= gone_after:
                    return False
            x, y = made[before], made[after]
            if x[0] < 0 and y[0] < 0:
                return True
            if x[0] > y[0]:
                gone_before, before = x[0], x[2]
            else:
                gone_after, after = y[0], y[1]

    def chunk_ids(self, chunk: str) -> list[int]:
        """The ids of a chunk: the table of its prefixes' last tokens, read backwards."""
        last, size = [_UNKNOWN] * (len(chunk) + 1), [1] * (len(chunk) + 1)
        verdicts, compatible, names = self.verdicts, self.compatible, self.names
        for end, number in self.automaton.by_end(chunk):
            if last[end] == _UNKNOWN:
                length = len(names[number])
                before = last[end - length]
                if before != _UNKNOWN and end != length:
                    ok = verdicts.get(before << 16 | number)
                    if not (compatible(before, number) if ok is None else ok):
                        continue
                last[end], size[end] = number, length
        out: list[int] = []
        end = len(chunk)
        while end:
            if last[end] == _UNKNOWN:
                out += [self.byte_ids[x] for x in reversed(chunk[end - 1].encode())]
            else:
                out.append(last[end])
            end -= size[end]
        out.reverse()
        return out

    def compatible_pairs(self, before: np.ndarray, after: np.ndarray) -> np.ndarray:
        key = before << 16 | after
        seat = _seat(key)
        found = self.seats[seat]
        for i in np.flatnonzero(found >> 1 != key).tolist():
            found[i] = int(key[i]) << 1 | self.compatible(int(before[i]), int(after[i]))
            self.seats[seat[i]] = found[i]
        return found & 1 == 1

    def learn(self, chunks: list[str]) -> None:
        """Fill the tables of many short chunks together, one place of all chunks after another, and keep what they give."""
        size = np.fromiter(map(len, chunks), np.int64, len(chunks))
        stop = np.cumsum(size + 1) - 1
        first = stop - size
        start, end, number = self.automaton.found(self.between.join(chunks))
        place = end - np.repeat(first, size + 1)[start]
        order = np.argsort(place, kind="stable")
        start, end, number, place = start[order], end[order], number[order], place[order]
        last = np.full(int(stop[-1]) + 1, _UNKNOWN, np.int64)
        edges = np.searchsorted(place, np.arange(1, int(size.max()) + 2))
        for a, z in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
            before = last[start[a:z]]
            ok = before == _UNKNOWN  # the start of a chunk, or a character that is no piece
            rest = np.flatnonzero(~ok)
            ok[rest] = self.compatible_pairs(before[rest], number[a:z][rest])
            last[end[a:z][ok]] = number[a:z][ok]
        steps, at = [], stop.copy()
        while (at > first).any():
            steps.append(np.where(at > first, last[at], -1))
            at = np.where(at > first, at - np.where(last[at] == _UNKNOWN, 1, self.sizes[last[at]]), at)
        for chunk, ids in zip(chunks, np.stack(steps[::-1], axis=1).tolist(), strict=True):
            ids = self.chunk_ids(chunk) if _UNKNOWN in ids else ids[ids.count(-1) :]
            self.kept[chunk] = self._told(ids)

    def _told(self, ids: list[int]) -> tuple[int, bytes, bytes]:
        numerals, plain = self.numerals, self.plain
        texts = [plain[x] for x in ids]
        return len(ids), b",".join([numerals[x] for x in ids]), self.spelled(ids) if None in texts else b"".join(texts)

    def told(self, chunks: list[str]) -> list[tuple[int, bytes, bytes]]:
        """What is kept of chunks, after learning the new ones; long ones are not kept."""
        kept = self.kept
        if len(kept) > KEPT:
            kept.clear()
        out = [kept.get(x) for x in chunks]
        new = {x for x, y in zip(chunks, out, strict=True) if y is None and len(x) <= KEPT_CHARS} if None in out else ()
        lot, chars = [], 0
        for x in new:
            lot.append(x)
            chars += len(x)
            if chars >= NEW:
                self.learn(lot)
                lot, chars = [], 0
        if lot:
            self.learn(lot)
        return [y or kept.get(x) or self._told(self.chunk_ids(x)) for x, y in zip(chunks, out, strict=True)]

    def chunks(self, text: str) -> Iterator[list[str]]:
        """Lists of the chunks of a text, white space written as U+2581 and one put in front."""
        marked = SPACE + text.replace(" ", SPACE) if text else ""
        if len(marked) <= LOT:
            yield self.chunk.findall(marked)
            return
        each = map(re.Match.group, self.chunk.finditer(marked))
        while lot := list(islice(each, LOT >> 4)):
            yield lot

    def ids(self, text: str | None) -> list[int]:
        return [x for lot in self.chunks(text or "") for chunk in lot for x in self.chunk_ids(chunk)]

    def spelled(self, ids: Iterable[int]) -> bytes:
        """The text of ids within a text; bytes that are no UTF-8 become U+FFFD each."""
        ids, texts = list(ids), self.texts
        if ids and not 0 <= min(ids) <= max(ids) < len(texts):
            raise ValueError(f"no piece has the id {min(ids) if min(ids) < 0 else max(ids)}")
        parts, loose = [], b""
        for number in ids:
            if number in self._bytes:
                loose += self._bytes[number]
                continue
            parts += [_readable(loose), texts[number] or b""]
            loose = b""
        return b"".join([*parts, _readable(loose)])

    @cached_property
    def _bytes(self) -> dict[int, bytes]:
        return {number: bytes([x]) for x, number in enumerate(self.byte_ids)}

    def text(self, ids: Iterable[int] | None) -> str:
        """The text that ids decode to; the white space put in front is taken away."""
        ids = list(ids or ())
        out = self.spelled(ids).decode()
        # control pieces are silent, bytes are not
        first = next((x for x in ids if self.texts[x] is not None or x in self._bytes), None)
        return out[1:] if first is not None and (self.texts[first] or b"").startswith(b" ") else out


def _readable(loose: bytes) -> bytes:
    """Bytes as UTF-8, each of those that belong to no character as U+FFFD."""
    try:
        loose.decode()
        return loose
    except UnicodeDecodeError as e:
        return loose[: e.start] + "�".encode() + _readable(loose[e.start + 1 :])


def load(path: str) -> Model:
    """Read a model file; a ValueError if it is of a kind that is not handled."""
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=path)
    numbers = range(library.get_piece_size())
    names = [library.id_to_piece(i) for i in numbers]
    byte_ids = [-1] * 256
    for i in numbers:
        if library.is_byte(i):
            byte_ids[int(names[i][3:5], 16)] = i
    if len(names) > 1 << 16:
        raise ValueError(f"{path}: more than 65536 pieces")
    if min(byte_ids) < 0:
        raise ValueError(f"{path}: not every byte has a piece")
    plain = [i for i in numbers if not (library.is_byte(i) or library.is_control(i) or library.is_unknown(i))]
    texts: list[bytes | None] = [None] * len(names)
    for i in plain:
        texts[i] = names[i].replace(SPACE, " ").encode()
    for i in numbers:
        if library.is_unknown(i):
            texts[i] = library.decode([i]).encode()
    out = Model({names[i]: (i, library.get_score(i)) for i in plain}, byte_ids, texts)
    for probe in PROBES:
        want = library.encode(probe, add_bos=False, add_eos=False, enable_sampling=False)
        if out.ids(probe) != want or out.text(want) != library.decode(want):
            raise ValueError(f"{path}: a model of another kind, it differs on {probe!r}")
    return out


def _shared(docs: DataFrame, model: Model | str):
    return docs.sparkSession.sparkContext.broadcast(load(model) if isinstance(model, str) else model)


def _added(docs: DataFrame, column: str, out: str, kind: T.DataType, arrow: pa.DataType, each) -> DataFrame:
    keep = [c for c in docs.columns if c.lower() != out.lower()]
    base = docs.select(*keep, *([] if column in keep else [column]))
    at = base.columns.index(column)
    schema = T.StructType([*[base.schema[c] for c in keep], T.StructField(out, kind)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = pa.array([each(x.as_py()) for x in batch.column(at)], arrow)
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(len(keep))), made], schema.names)

    return map_batches(base, run, schema)


def encode(docs: DataFrame, model: Model | str, column: str = "text", out: str = "ids") -> DataFrame:
    """docs with the ids of a text column."""
    shared = _shared(docs, model)
    return _added(docs, column, out, T.ArrayType(T.IntegerType()), pa.list_(pa.int32()), lambda x: shared.value.ids(x))


def decode(rows: DataFrame, model: Model | str, column: str = "ids", out: str = "text") -> DataFrame:
    """rows with the text that a column of ids decodes to."""
    shared = _shared(rows, model)
    return _added(rows, column, out, T.StringType(), pa.string(), lambda x: shared.value.text(x))


def described(model: Model, texts: Iterable[str | None]) -> Iterator[tuple[int, str, str]]:
    """(number of ids, SHA-256 of the ids joined by commas, SHA-256 of the decoded text) of texts, some of them at a time."""
    open_text: list = [0, hashlib.sha256(), hashlib.sha256()]

    def added(lots: list[tuple[list[str], bool]]) -> Iterator[tuple[int, str, str]]:
        rows = iter(model.told([x for lot, _ in lots for x in lot]))
        for lot, ended in lots:
            own = list(islice(rows, len(lot)))
            count, ids, decoded = open_text
            if own:
                spelled = b"".join([x[2] for x in own])
                # the first chunk starts with the white space that was put in front
                decoded.update(spelled if count else spelled[1:])
                ids.update((b"," if count else b"") + b",".join([x[1] for x in own]))
                open_text[0] += sum([x[0] for x in own])
            if ended:
                yield open_text[0], ids.hexdigest(), decoded.hexdigest()
                open_text[:] = [0, hashlib.sha256(), hashlib.sha256()]

    waiting, chunks = [], 0
    for text in texts:
        for lot in model.chunks(text or ""):
            waiting.append((lot, False))
            chunks += len(lot)
            if chunks >= LOT >> 4:
                yield from added(waiting)
                waiting, chunks = [], 0
        waiting.append(([], True))
    yield from added(waiting)


def digest(docs: DataFrame, model: Model | str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of every document."""
    shared = _shared(docs, model)
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
        for batch in batches:
            rows = list(described(shared.value, (x.as_py() for x in batch.column(1))))
            columns = list(zip(*rows, strict=True)) or [(), (), ()]
            kinds = (pa.int64(), pa.string(), pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))], names)

    return map_batches(narrow, run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
