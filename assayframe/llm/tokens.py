"""Word and shingle hashes of whole texts, computed by numpy over UTF-8 bytes.

A word is a maximal run of bytes other than space and 0x09-0x0D.  The hash of
a word is a polynomial in an odd base modulo 2**64, taken for all words at
once from one running sum: the sum over a word's bytes divided by the base's
power at its start.  Odd numbers can be inverted modulo 2**64.
"""

from __future__ import annotations

import numpy as np

BASE = 0x9E3779B97F4A7C55
_ODD = np.array([0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3], np.uint64)

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_tables: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    have = _tables.get("power")
    if have is None or len(have) < n:
        size = 1 << max(16, int(n - 1).bit_length())
        for name, base in (("power", BASE), ("inverse", pow(BASE, -1, 1 << 64))):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _tables[name] = np.multiply.accumulate(steps)
    return _tables["power"], _tables["inverse"]


def mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(30))
    x = x * _ODD[0]
    x = x ^ (x >> np.uint64(27))
    x = x * _ODD[1]
    return x ^ (x >> np.uint64(31))


def word_bounds(data: np.ndarray, offsets: np.ndarray, space: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words of all documents; no word passes a document's bounds."""
    inside = ~space[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    heads = offsets[:-1][offsets[:-1] < offsets[1:]]
    first[heads] = inside[heads]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    tails = offsets[1:][offsets[:-1] < offsets[1:]] - 1
    last[tails] = inside[tails]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each byte span."""
    power, inverse = _powers(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power[: len(data)], out=total[1:])
    return mix((total[ends] - total[starts]) * inverse[starts])


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the A-Z lower-cased words, and for each document the index of its first word (one entry more)."""
    low = LOWER[data]
    starts, ends = word_bounds(low, offsets)
    return span_hashes(low, starts, ends), np.searchsorted(starts, offsets)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, k: int = 5) -> list[np.ndarray]:
    """The sorted distinct k-word shingle hashes of each document (63 bits, as the lowest bit is left free).

    With fewer words the whole sequence is one shingle; without words the set is empty.
    """
    words, at = word_hashes(data, offsets)
    free = ~np.uint64(1)
    rolled = np.zeros(max(0, len(words) - k + 1), np.uint64)
    for j in range(k):
        rolled += words[j : j + len(rolled)] * (_ODD[j % len(_ODD)] + np.uint64(2 * (j // len(_ODD))))
    rolled = mix(rolled) & free
    out = []
    for a, z in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
        if z - a >= k:
            out.append(np.unique(rolled[a : z - k + 1]))
        elif z > a:
            h = np.array([(z - a) * BASE & (2**64 - 1)], np.uint64)
            for j in range(a, z):
                h = mix(h ^ words[j]) + _ODD[2:3]
            out.append(h & free)
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def set_hash(tokens: np.ndarray) -> int:
    """One signed 64-bit number for a set of tokens; equal sets have equal numbers."""
    h = (int(mix(tokens ^ _ODD[4]).sum(dtype=np.uint64)) + len(tokens) * BASE) & (2**64 - 1)
    return int(mix(np.array([h], np.uint64)).view(np.int64)[0])
