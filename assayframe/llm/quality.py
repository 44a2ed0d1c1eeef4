"""Quality classifier: weak labels by expectation-maximisation, then a hashed linear scorer.

1. Heuristic labellers look at counts of the whole text and vote good (2),
   bad (0) or nothing (1).  They overlap: several look at the same text.
2. The rows are counted by vote pattern (at most 3 ** labellers patterns).
   Expectation-maximisation over the patterns of all documents estimates each
   labeller's accuracy and the share of good documents; a pattern's posterior
   is its documents' weak label.
3. A linear scorer over hashed tokens and token shapes is fitted to the
   posteriors of about ``train_docs`` documents, or fewer where these would
   have more than ``train_bytes`` of text, chosen by a hash of doc_id and text,
   in one task of bounded size; it scores every document.

What tells good from bad is the start of the maximisation, labellers that are
right more often than not, and a weak prior of the same kind: ``PRIOR`` times
as many votes as there are documents.

Features are relative frequencies, so scores don't depend on the length.

Defined cases: null, empty or white-space text gets one bad vote (for its
length) and no other, the score 0, and isn't kept; equal texts get equal
labels and scores; repeated rows count as often as they stand there; an empty
table stays empty; other columns, whatever their names, are ignored by
``digest`` and kept by ``keep_good``; ``score`` replaces those with the names
it adds.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import map_batches, private, text_slices
from .tokens import SPACE, mix, span_hashes, word_bounds

BUCKETS = 1 << 15
TRAIN_DOCS = 6000
TRAIN_BYTES = 24 << 20
LABELLERS = ("capitals", "separators", "shouting", "symbols", "noise", "short_words", "repeated_words", "stutter", "length")
BAD, NONE, GOOD = 0, 1, 2
#: Start and prior of the chances of bad, no and good votes on bad and on good documents; the prior's share of all votes.
START = ((0.4, 0.1, 0.5), (0.001, 0.14, 0.859))
PRIOR = 0.01
#: Share of good documents to begin with, and of the prior.
SHARE = 0.8

_LETTER_UP, _LETTER_LOW, _DIGIT, _STOP, _BAR, _BANG, _MARK = range(7)


def _classes() -> np.ndarray:
    """Byte classes: capitals, small letters (and all non-ASCII), digits, punctuation of prose, bars, exclamations, other marks."""
    out = np.full(256, -1, np.int8)
    out[33:127] = _MARK
    out[65:91], out[97:123], out[128:], out[48:58] = _LETTER_UP, _LETTER_LOW, _LETTER_LOW, _DIGIT
    out[[ord(c) for c in ".?,;:'\"()-"]], out[ord("|")], out[ord("!")] = _STOP, _BAR, _BANG
    return out


CLASS = _classes()


def counted(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """Counts for each document of a slice."""
    rows = len(offsets) - 1
    kind = CLASS[data]
    sums = {}
    for name, code in (("up", _LETTER_UP), ("low", _LETTER_LOW), ("stop", _STOP), ("bar", _BAR), ("bang", _BANG), ("mark", _MARK)):
        total = np.zeros(len(data) + 1, np.int64)
        np.cumsum(kind == code, out=total[1:])
        sums[name] = total[offsets[1:]] - total[offsets[:-1]]
    starts, ends = word_bounds(data, offsets)
    at = np.searchsorted(starts, offsets)
    sums["words"] = np.diff(at)
    row = np.repeat(np.arange(rows), sums["words"])
    spelled = np.isin(CLASS[data[starts]], (_LETTER_UP, _LETTER_LOW))
    sums["spelled"] = np.bincount(row, spelled, rows).astype(np.int64)
    sums["short"] = np.bincount(row, spelled & (ends - starts <= 4), rows).astype(np.int64)
    # distinct among the first of every 200 words or fewer: comparable between short and long texts
    hashes = span_hashes(data, starts, ends)
    again = np.r_[False, (hashes[1:] == hashes[:-1]) & (row[1:] == row[:-1])] if len(row) else np.zeros(0, bool)
    sums["again"] = np.bincount(row, again, rows).astype(np.int64)
    distinct, looked = np.zeros(rows, np.int64), np.zeros(rows, np.int64)
    for i in np.flatnonzero(sums["words"]):
        own = hashes[at[i] : at[i + 1]]
        chunk = np.arange(len(own)) // 200
        distinct[i] = len(np.unique(mix(own + chunk.astype(np.uint64))))
        looked[i] = len(own)
    return sums | {"distinct": distinct, "looked": looked}


def votes(c: dict[str, np.ndarray]) -> np.ndarray:
    """Votes of all labellers (columns) for each document (rows)."""
    words = np.maximum(1, c["words"])
    letters = np.maximum(1, c["up"] + c["low"])
    capitals, bars, bangs = c["up"] / letters, c["bar"] / words, c["bang"] / words
    noise = (c["bar"] + c["bang"] + c["mark"]) / words
    short, marks, fresh = c["short"] / np.maximum(1, c["spelled"]), c["mark"] / words, c["distinct"] / np.maximum(1, c["looked"])
    choose = lambda bad, good: np.where(bad, BAD, np.where(good, GOOD, NONE))
    out = np.stack([
        choose(capitals > 0.3, capitals < 0.1),
        choose(bars > 0.1, bars < 0.02),
        choose(bangs > 0.15, bangs < 0.05),
        choose(marks > 0.3, marks < 0.1),
        choose(noise > 0.2, noise < 0.08),
        choose(short < 0.1, (short > 0.25) & (short < 0.75)),
        choose(fresh < 0.15, fresh > 0.4),
        choose(c["again"] / words > 0.2, c["again"] / words < 0.05),
        choose(c["words"] < 3, c["words"] > 30),
    ], axis=1)
    out[c["words"] == 0, :-1] = NONE
    return out


def pattern_codes(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    return votes(counted(data, offsets)) @ (3 ** np.arange(len(LABELLERS)))


def estimate(patterns: np.ndarray, counts: np.ndarray, rounds: int = 200) -> tuple[np.ndarray, np.ndarray, float]:
    """(posterior of good for each pattern, chances of votes, share of good) by expectation-maximisation.

    chances[class, labeller, vote] is how often a labeller casts a vote on
    documents of a class (0 bad, 1 good): its accuracies on either class.
    """
    vote = patterns[:, None] // 3 ** np.arange(len(LABELLERS)) % 3
    cast = (vote[:, :, None] == np.arange(3)).astype(float)
    prior = np.array(START)
    chances = np.tile(prior[:, None, :], (1, len(LABELLERS), 1))
    share, good = SHARE, np.zeros(len(patterns))
    for _ in range(rounds):
        log = np.einsum("plv,clv->pc", cast, np.log(chances))
        good = 1 / (1 + np.exp(np.clip(log[:, 0] - log[:, 1] - np.log(share / (1 - share)), -500, 500)))
        for c, belongs in ((0, 1 - good), (1, good)):
            seen = np.einsum("plv,p->lv", cast, belongs * counts) + PRIOR * counts.sum() * prior[c]
            chances[c] = seen / seen.sum(axis=1, keepdims=True)
        share = float(((good * counts).sum() + PRIOR * counts.sum() * SHARE) / (max(1, counts.sum()) * (1 + PRIOR)))
    return good, chances, share


def hashed(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, bucket, share) of the features: tokens as written, their shapes, pairs of shapes that follow, repeats of the token before."""
    rows = len(offsets) - 1
    starts, ends = word_bounds(data, offsets, SPACE)
    words = np.diff(np.searchsorted(starts, offsets))
    row = np.repeat(np.arange(rows), words)
    kind = CLASS[data].astype(np.int64)
    size = ends - starts
    size = np.where(size < 8, size, 5 + np.log2(np.maximum(1, size)).astype(np.int64))
    shape = ((kind[starts] * 8 + kind[np.maximum(starts, ends - 1)]) * 8 + kind[np.minimum(starts + 1, ends - 1)]) * 64 + size
    pair = np.where(np.r_[False, row[1:] == row[:-1]][: len(row)], np.r_[0, shape[:-1]][: len(row)], -1) * 100_003 + shape
    whole = span_hashes(data, starts, ends)
    again = np.r_[False, (whole[1:] == whole[:-1]) & (row[1:] == row[:-1])] if len(row) else np.zeros(0, bool)
    bucket = np.concatenate([whole, mix(again.astype(np.uint64) + np.uint64(1 << 42)), mix(shape.astype(np.uint64) + np.uint64(1 << 40)), mix(pair.astype(np.uint64) + np.uint64(1 << 41))]) % np.uint64(BUCKETS)
    key, many = np.unique(np.tile(row, 4) * BUCKETS + bucket.astype(np.int64), return_counts=True)
    return key // BUCKETS, key % BUCKETS, many / np.maximum(1, words)[key // BUCKETS]


def train(row: np.ndarray, bucket: np.ndarray, value: np.ndarray, label: np.ndarray, rounds: int = 150) -> np.ndarray:
    """Weights (and the bias, last) of a logistic fit to soft labels by gradient steps scaled to each feature's size."""
    weight, squares = np.zeros(BUCKETS + 1), np.full(BUCKETS + 1, 1e-6)
    rows = max(1, len(label))
    for _ in range(rounds):
        score = np.bincount(row, value * weight[bucket], len(label)) + weight[-1]
        error = 1 / (1 + np.exp(-score)) - label
        gradient = np.r_[np.bincount(bucket, value * error[row], BUCKETS), error.sum()] / rows + 1e-6 * weight
        squares += gradient**2
        weight -= 0.3 * gradient / np.sqrt(squares)
    return weight


def fit(docs: DataFrame, train_docs: int = TRAIN_DOCS, train_bytes: int = TRAIN_BYTES) -> tuple[dict[int, float], np.ndarray, np.ndarray]:
    """(posterior by pattern, scorer's weights, chances of votes) from the columns doc_id and text."""

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes, sizes = [], []
            for _, offsets, data in text_slices(batch.column(0)):
                codes.append(pattern_codes(data, offsets))
                sizes.append(np.diff(offsets))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x) if x else [], pa.int64()) for x in (codes, sizes)], ["pattern", "size"])

    coded = map_batches(docs.select("text"), code, "pattern long, size long")
    table = coded.groupBy("pattern").agg(F.count("*").alias("n"), F.sum("size").alias("size")).toPandas().sort_values("pattern")  # 3 ** labellers rows at most
    patterns, counts = table["pattern"].to_numpy(np.int64), table["n"].to_numpy(np.float64)
    if not len(patterns):
        return {}, np.zeros(BUCKETS + 1), np.zeros((2, len(LABELLERS), 3))
    good, accuracy, _ = estimate(patterns, counts)
    posterior = dict(zip(patterns.tolist(), good.tolist(), strict=True))
    chance = F.pmod(F.xxhash64(F.lit("quality"), F.col("doc_id"), F.col("text")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    sample = docs.where(chance < min(train_docs / max(1.0, counts.sum()), train_bytes / max(1, int(table["size"].sum())))).select("text")

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, labels = [], []
        for batch in batches:
            for _, offsets, data in text_slices(batch.column(0)):
                row, bucket, value = hashed(data, offsets)
                parts.append((row + sum(map(len, labels)), bucket, value))
                labels.append(np.array([posterior[c] for c in pattern_codes(data, offsets).tolist()]))
        if labels:
            weight = train(*(np.concatenate(x) for x in zip(*parts, strict=True)), np.concatenate(labels))
            yield pa.RecordBatch.from_arrays([pa.array([weight.tolist()], pa.list_(pa.float64()))], ["weight"])

    # about train_docs documents and train_bytes bytes at most, whatever the size of the corpus: one task
    got = map_batches(sample.repartition(1), learn, "weight array<double>").first()
    return posterior, np.array(got["weight"]) if got else np.zeros(BUCKETS + 1), accuracy


def score(docs: DataFrame, posterior: dict[int, float], weight: np.ndarray, added: tuple[str, str] = ("quality_label", "quality_score")) -> DataFrame:
    """docs with the posterior of the votes and the linear scorer's score, 0 to 1."""
    model = docs.sparkSession.sparkContext.broadcast((posterior, weight))
    base = docs.drop(*added)
    at = base.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, w = model.value
        for batch in batches:
            labels, scores = [], []
            for _, offsets, data in text_slices(batch.column(at)):
                labels += [known.get(c, 0.0) for c in pattern_codes(data, offsets).tolist()]
                row, bucket, value = hashed(data, offsets)
                rows = len(offsets) - 1
                raw = np.bincount(row, value * w[bucket], rows) + w[-1]
                words = np.bincount(row, minlength=rows) > 0
                scores.append(np.where(words, 1 / (1 + np.exp(-raw)), 0.0))
            done = np.concatenate(scores) if scores else np.zeros(0)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(labels, pa.float64()), pa.array(done)], [*batch.schema.names, *added])

    return map_batches(base, run, T.StructType([*base.schema.fields, *[T.StructField(x, T.DoubleType()) for x in added]]))


def digest(docs: DataFrame, train_docs: int = TRAIN_DOCS, least: float = 0.5) -> DataFrame:
    """(doc_id, quality_label, quality_score, keep) of every document."""
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    posterior, weight, _ = fit(narrow, train_docs)
    out = score(narrow, posterior, weight)
    return out.select("doc_id", F.round("quality_label", 6).alias("quality_label"), F.round("quality_score", 6).alias("quality_score"), (F.col("quality_score") >= least).alias("keep"))


def keep_good(docs: DataFrame, train_docs: int = TRAIN_DOCS, least: float = 0.5) -> DataFrame:
    """docs that the scorer takes for good, with their own columns."""
    posterior, weight, _ = fit(docs.select("doc_id", "text"), train_docs)
    label, points = private(docs, "quality_label", "quality_score")
    return score(docs, posterior, weight, (label, points)).where(F.col(points) >= least).select(*docs.columns)
