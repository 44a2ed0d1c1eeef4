"""Media columns: telephony audio as WAV bytes, decoded by lookup tables and numpy, stored as resampled PCM.

Payload bytes are kept losslessly in a RIFF container, as 8-bit mu-law or A-law
codes, or as the 4-bit codes of IMA ADPCM blocks (64 payload bytes and a header
each).  Which of them is up to the payload: its CRC-32 modulo 3.  All carry 64
kbit/s: mu-law and A-law have ``RATE`` samples a second, ADPCM twice as many.
Media are written as a table and read back.  Decoding expands the codes by a
256-entry table; the ADPCM blocks of many rows are decoded together, one step of
numpy per sample position across all blocks.  Decoded audio is resampled to
``PCM_RATE`` by means of neighbours (down) or by linear interpolation (up), and
written as 16-bit PCM; features are those of the stored PCM.

Tables are compressed by zstd, as PCM of 16 bits is twice its codes.  ``digest``
takes the documents in ``TURNS`` parts by a hash of their rows: a part's media
are deleted when they have been read back and their PCM is written, so PCM of
all documents and media of one part lie on disk at once.

Defined cases: null is an empty payload; empty payloads are padded to one
unit of 64 bytes; long texts are handled row by row; equal payloads give equal
bytes and features; repeated rows give repeated results; other columns are
passed through by ``store_payload`` and ``store_pcm`` (a column with the name
of the one added is replaced) and ignored by ``digest``.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import SLICE_BYTES, map_batches, unwritten, written

UNIT = 64
RATE = 8000
PCM_RATE = 8000
#: Bytes of an ADPCM block: a header of 4 and the codes.
BLOCK = UNIT + 4
#: Parts of the documents whose media are on disk one after the other.
TURNS = 2
#: How media and PCM are written.
STORED = {"compression": "zstd", "parquet.compression.codec.zstd.level": "12"}
#: RIFF format tags (fixed values): PCM, A-law, mu-law, IMA ADPCM.
TAGS = {"pcm": 1, "alaw": 6, "mulaw": 7, "ima": 17}


def mulaw_table() -> np.ndarray:
    """16-bit sample of each mu-law code: inverted bits of sign, exponent and mantissa, bias 132."""
    code = ~np.arange(256) & 0xFF
    size = (((code & 15) << 3) + 132 << (code >> 4 & 7)) - 132
    return np.where(code & 128, -size, size).astype(np.int16)


def alaw_table() -> np.ndarray:
    """16-bit sample of each A-law code: even bits inverted, linear in the lowest segment."""
    code = np.arange(256) ^ 0x55
    exponent, mantissa = code >> 4 & 7, code & 15
    size = np.where(exponent == 0, (mantissa << 4) + 8, ((mantissa << 4) + 264) << np.maximum(exponent - 1, 0))
    return np.where(code & 128, size, -size).astype(np.int16)


def ima_steps() -> np.ndarray:
    """The 89 quantizer step sizes."""
    # fixed values of the IMA ADPCM format
    return np.array([
        7, 8, 9, 10, 11, 12, 13, 14, 16, 17, 19, 21, 23, 25, 28, 31, 34, 37, 41, 45, 50, 55, 60, 66, 73, 80, 88, 97, 107, 118,
        130, 143, 157, 173, 190, 209, 230, 253, 279, 307, 337, 371, 408, 449, 494, 544, 598, 658, 724, 796, 876, 963, 1060, 1166,
        1282, 1411, 1552, 1707, 1878, 2066, 2272, 2499, 2749, 3024, 3327, 3660, 4026, 4428, 4871, 5358, 5894, 6484, 7132, 7845,
        8630, 9493, 10442, 11487, 12635, 13899, 15289, 16818, 18500, 20350, 22385, 24623, 27086, 29794, 32767,
    ], np.int32)


MULAW, ALAW, STEPS = mulaw_table(), alaw_table(), ima_steps()
#: fixed values: change of the step index by the low three bits of a code.
INDEX_CHANGE = np.array([-1, -1, -1, -1, 2, 4, 6, 8], np.int32)


def wav(kind: str, data: bytes, rate: int = RATE, block: int = 1) -> bytes:
    """A mono RIFF file of one fmt, fact and data chunk."""
    tag, bits = TAGS[kind], {"pcm": 16, "ima": 4}.get(kind, 8)
    align = {"pcm": 2, "ima": block}.get(kind, 1)
    fmt = struct.pack("<HHIIHHH", tag, 1, rate, rate * align if kind != "ima" else rate // 2, align, bits, 0)
    fact = struct.pack("<I", len(data) // 2 if kind == "pcm" else len(data))
    chunks = b"".join(name + struct.pack("<I", len(body)) + body for name, body in ((b"fmt ", fmt), (b"fact", fact), (b"data", data)))
    return b"RIFF" + struct.pack("<I", 4 + len(chunks)) + b"WAVE" + chunks


def read_wav(media: bytes) -> tuple[str, int, int, bytes]:
    """(kind, rate, block size, data) of a RIFF file."""
    if media[:4] != b"RIFF" or media[8:12] != b"WAVE":
        raise ValueError("not a RIFF WAVE file")
    at, found = 12, {}
    while at + 8 <= len(media):
        size = struct.unpack_from("<I", media, at + 4)[0]
        found[media[at : at + 4]] = (at + 8, size)
        at += 8 + size + size % 2
    tag, _, rate, _, align, _ = struct.unpack_from("<HHIIHH", media, found[b"fmt "][0])
    start, size = found[b"data"]
    return {v: k for k, v in TAGS.items()}[tag], rate, align, media[start : start + size]


def decode_ima(data: bytes, block: int) -> np.ndarray:
    """IMA ADPCM blocks to 16-bit samples: a header (sample, step index) and low-nibble-first codes in each block."""
    whole = len(data) // block * block
    blocks = np.frombuffer(data[:whole], np.uint8).reshape(-1, block)
    if not len(blocks):
        return np.zeros(0, np.int16)
    sample = blocks[:, :2].copy().view("<i2")[:, 0].astype(np.int32)
    index = np.clip(blocks[:, 2].astype(np.int32), 0, 88)
    codes = np.empty((len(blocks), (block - 4) * 2), np.uint8)
    codes[:, 0::2], codes[:, 1::2] = blocks[:, 4:] & 15, blocks[:, 4:] >> 4
    out = np.empty((len(blocks), codes.shape[1] + 1), np.int16)
    out[:, 0] = sample
    for j in range(codes.shape[1]):
        code, step = codes[:, j].astype(np.int32), STEPS[index]
        change = (step >> 3) + np.where(code & 4, step, 0) + np.where(code & 2, step >> 1, 0) + np.where(code & 1, step >> 2, 0)
        sample = np.clip(sample + np.where(code & 8, -change, change), -32768, 32767)
        index = np.clip(index + INDEX_CHANGE[code & 7], 0, 88)
        out[:, j + 1] = sample
    return out.reshape(-1)


def encode(payload: bytes, kind: str | None = None) -> bytes:
    """The WAV file that keeps a padded payload; the codec is the payload's own unless it is given."""
    kind = kind or ("mulaw", "alaw", "ima")[zlib.crc32(payload) % 3]
    if kind == "ima":
        blocks = np.zeros((len(payload) // UNIT, BLOCK), np.uint8)
        blocks[:, 4:] = np.frombuffer(payload, np.uint8).reshape(-1, UNIT)
        return wav(kind, blocks.tobytes(), 2 * RATE, BLOCK)
    return wav(kind, payload)


def payload_of(media: bytes) -> bytes:
    """The payload that a WAV file keeps."""
    kind, _, block, data = read_wav(media)
    return np.frombuffer(data, np.uint8).reshape(-1, block)[:, 4:].tobytes() if kind == "ima" else data


def decode_all(media: list[bytes]) -> list[tuple[int, np.ndarray]]:
    """(rate, 16-bit samples) of telephony WAV files; their ADPCM blocks of one size are decoded together."""
    read = [read_wav(x) for x in media]
    out: list = [None] * len(media)
    for i, (kind, rate, _, data) in enumerate(read):
        if kind == "pcm":
            out[i] = (rate, np.frombuffer(data, "<i2"))
        elif kind != "ima":
            out[i] = (rate, (MULAW if kind == "mulaw" else ALAW)[np.frombuffer(data, np.uint8)])
    for block in {x[2] for x in read if x[0] == "ima"}:
        own = [i for i, x in enumerate(read) if x[0] == "ima" and x[2] == block]
        data = [read[i][3][: len(read[i][3]) // block * block] for i in own]
        samples = decode_ima(b"".join(data), block)
        ends = np.cumsum([len(x) // block * ((block - 4) * 2 + 1) for x in data])
        for i, part in zip(own, np.split(samples, ends[:-1]), strict=True):
            out[i] = (read[i][1], part)
    return out


def decode(media: bytes) -> tuple[int, np.ndarray]:
    """(rate, 16-bit samples) of a telephony WAV file."""
    return decode_all([media])[0]


def resampled(samples: np.ndarray, rate: int, to: int) -> np.ndarray:
    """Samples at another rate, a multiple or a whole part of theirs, as 16-bit whole numbers rounded down.

    Down: the mean of each run of samples, a last short run too.  Up: linear
    interpolation, the last sample held.
    """
    wide = samples.astype(np.int64)
    if not len(wide) or to == rate:
        return samples.astype("<i2")
    if rate % to == 0:
        step = rate // to
        starts = np.arange(0, len(wide), step)
        return (np.add.reduceat(wide, starts) // np.minimum(step, len(wide) - starts)).astype("<i2")
    if to % rate:
        raise ValueError(f"{to} is neither a multiple nor a part of {rate}")
    step = to // rate
    after = np.r_[wide[1:], wide[-1]]
    return ((wide[:, None] * (step - np.arange(step)) + after[:, None] * np.arange(step)) // step).astype("<i2").reshape(-1)


def features(rate: int, samples: np.ndarray) -> str:
    """Whole numbers of PCM: rate, samples, peak, mean square, sign changes, CRC-32 of its bytes."""
    wide = samples.astype(np.int64)
    power = int((wide * wide).sum()) // max(1, len(wide))
    turns = int(np.count_nonzero((samples[1:] < 0) != (samples[:-1] < 0)))
    peak = int(np.abs(wide).max()) if len(wide) else 0
    return f"rate={rate};samples={len(samples)};peak={peak};power={power};turns={turns};crc={zlib.crc32(samples.astype('<i2').tobytes()):08x}"


def pad(payload: bytes) -> bytes:
    return payload + bytes(max(UNIT, -(-len(payload) // UNIT) * UNIT) - len(payload))


def _lots(column: pa.Array) -> Iterator[list]:
    """The values of a column in lots of about ``SLICE_BYTES``, one at least."""
    lot, size = [], 0
    for value in column:
        value = value.as_py()
        if lot and size + len(value or b"") > SLICE_BYTES:
            yield lot
            lot, size = [], 0
        lot.append(value)
        size += len(value or b"")
    if lot:
        yield lot


def _added(docs: DataFrame, column: str, fields: list[tuple[str, T.DataType]], each) -> DataFrame:
    """docs with new columns: each(values) makes rows of them from a lot of a column's values."""
    names = {x.lower() for x, _ in fields}
    keep = [c for c in docs.columns if c.lower() not in names]
    base = docs.select(*keep, *([] if column in keep else [column]))
    at = base.columns.index(column)
    schema = T.StructType([*[base.schema[c] for c in keep], *[T.StructField(*x) for x in fields]])
    kinds = {T.BinaryType(): pa.binary(), T.LongType(): pa.int64(), T.StringType(): pa.string()}
    titles, types = schema.names, [kinds[k] for _, k in fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = 0
            for lot in _lots(batch.column(at)):
                own = [batch.column(i).slice(done, len(lot)) for i in range(len(keep))]
                yield pa.RecordBatch.from_arrays([*own, *(pa.array(c, k) for c, k in zip(zip(*each(lot), strict=True), types, strict=True))], titles)
                done += len(lot)

    return map_batches(base, run, schema)


def store_payload(docs: DataFrame, kind: str | None = None, out: str = "media", column: str = "text") -> DataFrame:
    """docs with each text's padded UTF-8 bytes as a WAV file."""
    return _added(docs, column, [(out, T.BinaryType())], lambda lot: [(encode(pad((x or "").encode("utf-8", "replace")), kind),) for x in lot])


def store_pcm(media: DataFrame, column: str = "media", out: str = "pcm", to: int = PCM_RATE) -> DataFrame:
    """Add the decoded audio as 16-bit PCM bytes at a rate; null stays null."""

    def each(lot: list) -> list:
        pcm = iter([resampled(samples, rate, to).tobytes() for rate, samples in decode_all([x for x in lot if x is not None])])
        return [(None if x is None else next(pcm),) for x in lot]

    return _added(media, column, [(out, T.BinaryType())], each)


def digest(docs: DataFrame, kind: str | None = None, to: int = PCM_RATE) -> DataFrame:
    """Store every text as audio, read it back, store its PCM, and describe both (the contract's columns)."""
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"))

    def read_back(lot: list) -> list:
        rows = []
        for x, (rate, samples) in zip(lot, decode_all(lot), strict=True):
            payload = payload_of(x)
            rows.append((read_wav(x)[0], len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-UNIT:]), len(x), hashlib.sha256(x).hexdigest(), resampled(samples, rate, to).tobytes()))
        return rows

    text, number = T.StringType(), T.LongType()
    fields = [("codec", text), ("payload_bytes", number), ("payload_sha256", text), ("tail_crc32", number), ("media_bytes", number), ("media_sha256", text), ("pcm", T.BinaryType())]
    parts = []
    for turn in range(TURNS):
        own = narrow.where(F.pmod(F.xxhash64("doc_id", "text"), F.lit(TURNS)) == turn)
        media = written(store_payload(own, kind).drop("text"), "media", **STORED)
        parts.append(written(_added(media, "media", fields, read_back).drop("media"), "pcm", **STORED))
        unwritten(media)  # read back and described
    pcm = reduce(DataFrame.unionByName, parts)
    out = _added(pcm, "pcm", [("feature", text)], lambda lot: [(features(to, np.frombuffer(x, "<i2")),) for x in lot])
    feature = F.concat(F.lit("codec="), "codec", F.lit(";"), "feature").alias("feature")
    return out.select("doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", feature)
