"""Language ID: multinomial naive Bayes over hashed character n-grams.

The model counts n-grams of 1 to 3 code points of lower-cased texts, hashed
into ``BUCKETS`` columns, for each language.  Its log-probability matrix (4
bytes x buckets x languages) is broadcast, and batches are scored by numpy as
one sparse matrix: the buckets of all n-grams of many documents stand in one
array, documents are ranges of it; for each language the buckets' entries are
gathered and summed by range.  Entries are whole numbers of ``UNIT`` parts, so
that sums are exact: a score doesn't depend on the batch a text is in.

It is fitted on a bounded sample: about ``train_docs`` labelled documents of
each language, chosen by a hash of doc_id and text, all of them where a
language has fewer.  Labels, sources and ids never enter a prediction.

Defined cases: null text, and text without a letter, is ``und`` with score 0;
if nothing is labelled, everything is ``und``; ties go to the language that
sorts first; long texts are scored whole, piece by piece; other columns pass
through ``classify`` (columns it adds replace those of the same name) and
``keep_identified``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import map_batches, private, text_slices

BUCKETS = 1 << 16
ORDERS = (1, 2, 3)
TRAIN_DOCS = 2000
UNKNOWN = "und"
UNIT = 1 << 20
#: Characters of one piece of a long text.
PIECE = 1 << 19
_ASCII_LETTER = re.compile("[A-Za-z]")


def has_letter(text: str) -> bool:
    return _ASCII_LETTER.search(text) is not None or any(map(str.isalpha, text))


def buckets(points: np.ndarray, n: int) -> np.ndarray:
    """Bucket numbers of the n-grams from each place on."""
    size = max(0, len(points) - n + 1)
    h = np.full(size, n, np.uint64)
    for j in range(n):
        h = h * np.uint64(0x100000001B3) + points[j : j + size]
    return ((h * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(48)).astype(np.intp)


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32).astype(np.uint64)


def _pieces(texts: list[str | None]) -> Iterator[tuple[int, list[str], int]]:
    """(first row, lower-cased texts, characters at the end that were there before): several texts, or a piece of a long one.

    A piece takes the last characters of the one before it along, so that no n-gram is lost.
    """
    start, held, size = 0, [], 0
    more = max(ORDERS) - 1
    for i, text in enumerate(texts):
        low = (text or "").lower()
        if held and size + len(low) > PIECE:
            yield start, held, 0
            start, held, size = i, [], 0
        if len(low) > PIECE:
            for at in range(0, len(low), PIECE):
                yield i, [low[max(0, at - more) : at + PIECE]], min(at, more)
            start = i + 1
        else:
            held.append(low)
            size += len(low)
    if held:
        yield start, held, 0


def grams(texts: list[str | None]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, ends, buckets) of the n-grams of one order of several texts: a sparse matrix with a row for each text."""
    for first, pieces, again in _pieces(texts):
        points = _points("".join(pieces))
        size = np.array([len(x) for x in pieces], np.int64)
        for n in ORDERS:
            skip = max(0, again - n + 1)  # n-grams that were counted in the piece before
            many = np.maximum(0, size - n + 1 - skip)
            start = np.cumsum(size) - size + skip
            found = buckets(points, n)
            if len(pieces) > 1:
                inside = np.zeros(len(found) + 1, np.int32)
                own = many > 0
                np.add.at(inside, start[own], 1)
                np.add.at(inside, (start + many)[own], -1)
                found = found[np.cumsum(inside[:-1]) > 0]
            else:
                found = found[skip:]
            yield first, np.cumsum(many), found


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def fit(labelled: DataFrame, train_docs: int = TRAIN_DOCS, smoothing: float = 0.5) -> tuple[list[str], np.ndarray]:
    """(languages, matrix of languages x BUCKETS log-probabilities in UNIT parts) from the columns doc_id, text and lang.

    The driver gets the sums over the sample: a row of BUCKETS counts for each language.
    """
    known = labelled.where(F.col("lang").isNotNull() & F.col("text").isNotNull()).select("doc_id", "text", "lang")
    sizes = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return [], np.zeros((0, BUCKETS), np.int64)
    languages = sorted(sizes)
    share = F.create_map(*[x for k, n in sizes.items() for x in (F.lit(k), F.lit(min(1.0, train_docs / n)))])
    chance = F.pmod(F.xxhash64(F.lit("langid"), F.col("doc_id"), F.col("text")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    sample = known.where(chance < share[F.col("lang")]).select("text", "lang")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, np.ndarray] = {}
        for batch in batches:
            for text, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                total = totals.setdefault(lang, np.zeros(BUCKETS, np.int64))
                for _, _, found in grams([text]):
                    total += np.bincount(found, minlength=BUCKETS)
        for lang, total in totals.items():
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at, pa.int32()), pa.array(total[at], pa.int64())], ["lang", "bucket", "n"])

    counts = np.full((len(languages), BUCKETS), smoothing)
    row = {k: i for i, k in enumerate(languages)}
    got = map_batches(sample, count, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()
    counts[got["lang"].map(row).to_numpy(np.intp), got["bucket"].to_numpy(np.intp)] += got["n"].to_numpy()
    return languages, np.rint(np.log(counts / counts.sum(axis=1, keepdims=True)) * UNIT).astype(np.int64)


def score(texts: list[str | None], languages: list[str], matrix: np.ndarray) -> tuple[list[str], np.ndarray]:
    """(language, posterior probability) of every text under equal priors."""
    total = np.zeros((len(texts), len(languages)), np.int64)
    if languages:
        for first, ends, found in grams(texts):
            many = np.diff(np.r_[0, ends])
            rows = np.flatnonzero(many)
            if len(rows):
                for k, log in enumerate(matrix):
                    total[first + rows, k] += np.add.reduceat(log[found], (ends - many)[rows])
    judged = np.array([bool(languages) and x is not None and has_letter(x) for x in texts], bool)
    if not judged.any():
        return [UNKNOWN] * len(texts), np.zeros(len(texts))
    best = total.argmax(axis=1)
    behind = (total - total[np.arange(len(texts)), best][:, None]) / UNIT
    return [languages[b] if ok else UNKNOWN for b, ok in zip(best.tolist(), judged.tolist(), strict=True)], np.where(judged, 1.0 / np.exp(behind).sum(axis=1), 0.0)


def classify(docs: DataFrame, languages: list[str], matrix: np.ndarray, column: str = "text", added: tuple[str, str] = ("lang_pred", "lang_score")) -> DataFrame:
    """docs with the predicted language and its posterior."""
    model = docs.sparkSession.sparkContext.broadcast((languages, matrix.astype(np.int32)))
    base = docs.drop(*added)
    at = base.columns.index(column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, log = model.value
        log = log.astype(np.int64)
        for batch in batches:
            said, scores = [], []
            for first, offsets, _ in text_slices(batch.column(at)):
                a, b = score(batch.column(at).slice(first, len(offsets) - 1).to_pylist(), names, log)
                said += a
                scores.append(b)
            new = [pa.array(said, pa.string()), pa.array(np.concatenate(scores) if scores else [], pa.float64())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *new], [*batch.schema.names, *added])

    schema = T.StructType([*base.schema.fields, T.StructField(added[0], T.StringType()), T.StructField(added[1], T.DoubleType())])
    return map_batches(base, run, schema)


def digest(docs: DataFrame, train_docs: int = TRAIN_DOCS) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of every document; fitted on documents that are not held out."""
    model = fit(docs.where(~held_out(F.col("doc_id"))), train_docs)
    out = classify(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), *model)
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", F.col("lang_score").alias("score"))


def keep_identified(docs: DataFrame, train_docs: int = TRAIN_DOCS, least: float = 0.5) -> DataFrame:
    """Documents whose language is found with a score of ``least`` or more; columns as they were."""
    model = fit(docs.where(~held_out(F.col("doc_id"))), train_docs)
    pred, posterior = private(docs, "lang_pred", "lang_score")
    out = classify(docs, *model, added=(pred, posterior))
    return out.where((F.col(pred) != UNKNOWN) & (F.col(posterior) >= least)).select(*docs.columns)
