"""Quality classifier: a regularised quadratic discriminant over statistics of the text.

Every text gives a fixed number of statistics (lengths, kinds of characters, repetition), transformed so that each
is roughly bell-shaped: counts by logarithm, shares by the arc sine of the root. They are rounded to integers,
so that the sums a class needs (rows, values, products of two values) are exact and equal on every run, in
whatever order tasks add them. All labelled rows are summed; only two small rows of sums reach the driver.

The covariance of a class is shrunk towards the pooled one and towards a multiple of the identity, by fixed shares.
A score is the posterior of label 1: the difference of the two log densities, each the Mahalanobis distance by the
class's Cholesky factor, which is inverted once, plus log determinant and prior.

Defined results: a null text counts as an empty one and is scored like any other. A document with several labels
counts once for each different one; labels other than 0 and 1, and rows without doc_id, are not learned from. With
one class only, every score is that of the class (0 or 1); with none it is 0.5. Repeated rows are scored each.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tidemill.llm import words
from tidemill.llm.common import stored

#: Shares of the pooled covariance and of the identity in the covariance of a class.
POOLED, ROUND = 0.1, 0.02
THRESHOLD = 0.7
#: Steps of a statistic to one; the sums of squares of 10 ** 11 rows still fit 64 bits.
STEPS = 512

_WORD = words.byte_set((0x21, 0xFF)) & ~words.byte_set((0x7F, 0x7F))
_UPPER, _LOWER = words.byte_set((0x41, 0x5A)), words.byte_set((0x61, 0x7A))
_DIGIT = words.byte_set((0x30, 0x39))
_STOP = words.byte_set((0x21, 0x22), (0x27, 0x29), (0x2C, 0x2E), (0x3A, 0x3B), (0x3F, 0x3F))
_SIGN = words.byte_set((0x21, 0x7E)) & ~(_UPPER | _LOWER | _DIGIT | _STOP)
_CONTINUED = words.byte_set((0x80, 0xBF))  # the second and later bytes of a character

STATISTICS = [
    "log_words", "log_word_length", "upper", "digits", "signs", "stops", "exclamations", "distinct", "top_word",
    "echoed", "repeated_threes", "lines", "repeated_lines", "odd_words",
]


def held_out(doc_id: Column) -> Column:
    """Whether labels of a document are never learned from: crc32 of its id as text leaves 2 by 4."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def _per_text(marks: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """Marks between neighbouring edges."""
    sums = np.concatenate([[0], np.cumsum(marks, dtype=np.int64)])
    return sums[edges[1:]] - sums[edges[:-1]]


def _share(part: np.ndarray, whole: np.ndarray) -> np.ndarray:
    return np.arcsin(np.sqrt(np.clip(part / np.maximum(whole, 1), 0, 1)))


def _distinct(owner: np.ndarray, value: np.ndarray, texts: int) -> tuple[np.ndarray, np.ndarray]:
    """How many different values each text has, and how often its most frequent one occurs."""
    key = np.sort((owner.astype(np.uint64) << np.uint64(44)) | (value >> np.uint64(20)))
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
    of = (key[first] >> np.uint64(44)).astype(np.int64)
    top = np.zeros(texts, dtype=np.int64)
    np.maximum.at(top, of, np.diff(np.append(first, len(key))))
    return np.bincount(of, minlength=texts), top


def _statistics(texts: list[bytes]) -> np.ndarray:
    n = len(texts)
    data = np.frombuffer(b"".join(t + b"\n" for t in texts), dtype=np.uint8)
    edges = np.cumsum([0] + [len(t) + 1 for t in texts])

    def count(kind: np.ndarray) -> np.ndarray:
        return _per_text(kind[data], edges)

    starts, ends = words.spans(_WORD[data])
    owner = np.searchsorted(edges, starts, side="right") - 1
    value = words.hashes(data, starts, ends)
    n_words = np.bincount(owner, minlength=n)
    seen = n_words > 0
    characters = count(_WORD & ~_CONTINUED)
    letters = count(_UPPER | _LOWER) + count(words.byte_set((0xC0, 0xFF)))
    distinct, top = _distinct(owner, value, n)
    echoed = np.bincount(owner[1:][(value[1:] == value[:-1]) & (owner[1:] == owner[:-1])], minlength=n)
    three = (owner[2:] == owner[:-2]) if len(owner) > 2 else np.zeros(0, bool)
    mixed = (value[:-2] * np.uint64(3) + (value[1:-1] ^ (value[1:-1] >> np.uint64(31))) * np.uint64(5)
             + value[2:] * np.uint64(0x9E3779B97F4A7C15)) if len(owner) > 2 else np.zeros(0, np.uint64)
    n_threes = np.bincount(owner[:-2][three] if len(owner) > 2 else owner[:0], minlength=n)
    threes, _ = _distinct(owner[:-2][three] if len(owner) > 2 else owner[:0], mixed[three], n)
    line_starts, line_ends = words.spans(data != 10)
    line_owner = np.searchsorted(edges, line_starts, side="right") - 1
    n_lines = np.bincount(line_owner, minlength=n)
    lines, _ = _distinct(line_owner, words.hashes(data, line_starts, line_ends), n)
    signs_to = np.concatenate([[0], np.cumsum((_SIGN | _DIGIT)[data], dtype=np.int64)])
    odd = np.bincount(owner[signs_to[ends] > signs_to[starts]], minlength=n)
    columns = [
        np.log1p(n_words),
        np.log1p(characters / np.maximum(n_words, 1)),
        _share(count(_UPPER), letters),
        _share(count(_DIGIT), characters),
        _share(count(_SIGN), characters),
        _share(count(_STOP), characters),
        _share(count(words.byte_set((0x21, 0x21))), characters),
        np.where(seen, np.log1p(distinct) / np.log1p(np.maximum(n_words, 1)), 1),
        _share(top, n_words),
        _share(echoed, n_words),
        _share(n_threes - threes, n_threes),
        np.log1p(n_lines),
        _share(n_lines - lines, n_lines),
        _share(odd, n_words),
    ]
    return np.rint(np.stack(columns, axis=1) * STEPS).astype(np.int32)


def statistics(texts: list[str | None]) -> np.ndarray:
    """The transformed statistics of each text, in steps of 1 / ``STEPS``."""
    raw = [words.utf8(t) for t in texts]
    found = [_statistics(raw[a:b]) for a, b in words.runs(raw)]
    return np.concatenate(found) if found else np.zeros((0, len(STATISTICS)), dtype=np.int32)


def measured(docs: DataFrame) -> DataFrame:
    """doc_id and the statistics ``x`` of every row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = statistics(batch.column(1).to_pylist())
            lists = pa.ListArray.from_arrays(
                np.arange(0, x.size + 1, x.shape[1], dtype=np.int32), pa.array(x.ravel(), pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column(0), lists], names=["doc_id", "x"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, x array<int>")


def _moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows, sums and sums of products of each class in a task."""
    p = len(STATISTICS)
    sums = np.zeros((2, 1 + p + p * p), dtype=np.int64)
    for batch in batches:
        quality = batch.column(0).to_numpy(zero_copy_only=False)
        x = np.asarray(batch.column(1).flatten()).reshape(-1, p).astype(np.int64)
        for label in (0, 1):
            own = x[quality == label]
            sums[label] += np.concatenate([[len(own)], own.sum(axis=0), (own.T @ own).ravel()])
    at = np.tile(np.arange(sums.shape[1]), 2)
    yield pa.RecordBatch.from_arrays(
        [pa.array(np.repeat([0, 1], sums.shape[1]), pa.int32()), pa.array(at, pa.int32()), pa.array(sums.ravel())],
        names=["quality", "at", "total"])


@dataclass(frozen=True)
class Discriminant:
    """Of each class that has rows: log prior and half log determinant, mean, inverse of the Cholesky factor."""

    labels: tuple[int, ...]
    offsets: tuple[float, ...]
    means: tuple[np.ndarray, ...]
    whiteners: tuple[np.ndarray, ...]

    def score(self, x: np.ndarray) -> np.ndarray:
        """The posterior of label 1 for rows of statistics."""
        if len(self.labels) < 2:
            return np.full(len(x), float(self.labels[0]) if self.labels else 0.5)
        density = [
            offset - 0.5 * (((x / STEPS - mean) @ whitener.T) ** 2).sum(axis=1)
            for offset, mean, whitener in zip(self.offsets, self.means, self.whiteners)]
        return 1 / (1 + np.exp(np.clip(density[0] - density[1], -700, 700)))


def fit(rows: DataFrame, pooled: float = POOLED, around: float = ROUND) -> Discriminant:
    """The discriminant of rows of quality and ``x``, from all of them."""
    p = len(STATISTICS)
    partial = rows.select(F.col("quality").cast("int"), "x").mapInArrow(
        _moments, "quality int, at int, total long")
    sums = np.zeros((2, 1 + p + p * p))
    for r in partial.groupBy("quality", "at").agg(F.sum("total").alias("total")).collect():
        sums[r.quality, r.at] = r.total
    return discriminant(sums, pooled, around)


def discriminant(sums: np.ndarray, pooled: float = POOLED, around: float = ROUND) -> Discriminant:
    """From the rows, sums and sums of products of both classes."""
    p = len(STATISTICS)
    known = [label for label in (0, 1) if sums[label, 0] > 0]
    scatter, means = {}, {}
    for label in known:
        n = sums[label, 0]
        means[label] = sums[label, 1:1 + p] / n / STEPS
        scatter[label] = sums[label, 1 + p:].reshape(p, p) / STEPS ** 2 - n * np.outer(means[label], means[label])
    rows = sum(sums[label, 0] for label in known)
    common = sum(scatter.values(), np.zeros((p, p))) / max(rows, 1)
    offsets, whiteners = [], []
    for label in known:
        own = (1 - pooled) * scatter[label] / sums[label, 0] + pooled * common
        # the identity keeps the factor defined where a statistic never varies
        own = (1 - around) * own + around * max(np.trace(own) / p, 1e-6) * np.eye(p)
        factor = np.linalg.cholesky(own)
        whiteners.append(np.linalg.inv(factor))
        offsets.append(float(np.log(sums[label, 0] / rows) - np.log(np.diag(factor)).sum()))
    return Discriminant(tuple(known), tuple(offsets), tuple(means[k] for k in known), tuple(whiteners))


def labelled(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """Statistics of the rows whose labels may be learned from, with quality."""
    known = labels.where("quality in (0, 1) and doc_id is not null").select("doc_id", "quality").distinct()
    return rows.where(~held_out(F.col("doc_id"))).join(known, "doc_id")


def score(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score and predicted of every document, learned from the labels that are not held out."""
    rows = stored(measured(docs), "statistics")
    shared = docs.sparkSession.sparkContext.broadcast(fit(labelled(rows, labels)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.asarray(batch.column(2).flatten()).reshape(-1, len(STATISTICS))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(shared.value.score(x))],
                names=["doc_id", "held_out", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    scored = rows.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "x").mapInArrow(
        run, f"doc_id {kind}, held_out boolean, score double")
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
