"""Language ID: multinomial naive Bayes over hashed character n-grams.

The model is a matrix of log probabilities, languages by buckets. Its size is fixed by ``buckets`` and the
number of languages (``MOST_LANGS`` at most), so it is broadcast; texts are scored in numpy batches.

Defined results: a text that is null or has no letter is ``und`` with score 0, as is everything when nothing
could be learned. A row without doc_id is predicted but never learned from. Equal scores go to the
language that sorts first. Repeated rows are predicted each; columns beside those named are ignored. An empty
table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tidemill.llm.common import small_batches

BUCKETS = 1 << 15
ORDERS = (1, 2, 3)
#: Documents of a language that are learned from, as an expectation; fewer if there are fewer.
PER_LANG = 10_000
MOST_LANGS = 1_000
SMOOTHING = 0.5
_CHUNK = 1 << 18
_MULTIPLIERS = (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D)
_letters: np.ndarray | None = None


def held_out(doc_id: Column) -> Column:
    """Whether a document is never learned from: crc32 of its id as text leaves 0 by 5."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def _letter_table() -> np.ndarray:
    """Code point -> itself if it is a letter, else a space."""
    global _letters
    if _letters is None:
        points = np.arange(0x110000, dtype=np.uint32)
        letter = np.fromiter((chr(p).isalpha() for p in range(0x110000)), bool, 0x110000)
        _letters = np.where(letter, points, np.uint32(32))
    return _letters


def _chunks(texts: list[str]) -> Iterator[tuple[int, int]]:
    """Runs of texts of about ``_CHUNK`` characters; a longer text is a run of its own."""
    start = size = 0
    for i, text in enumerate(texts):
        if size and size + len(text) > _CHUNK:
            yield start, i
            start, size = i, 0
        size += len(text)
    if start < len(texts):
        yield start, len(texts)


def _buckets(texts: list[str]) -> tuple[list[np.ndarray], np.ndarray]:
    """Bucket of the n-gram at each place, for each order, and where each text starts.

    Texts are lower-cased and surrounded by spaces; n-grams of spaces alone, and those that cross into
    the next text, get the bucket past the last.
    """
    padded = [f"  {t.lower()} " for t in texts]
    starts = np.cumsum([0] + [len(t) for t in padded])
    raw = np.frombuffer("".join(padded).encode("utf-32-le", "surrogatepass"), dtype="<u4")
    points = _letter_table()[raw]
    n = len(points)
    owner_end = np.repeat(starts[1:], np.diff(starts))
    here = np.arange(n)
    found = []
    for order in ORDERS:
        h = np.full(n, order, dtype=np.uint32)
        blank = np.ones(n, dtype=bool)
        for j in range(order):
            shifted = np.full(n, 32, dtype=np.uint32)
            shifted[: n - j] = points[j:]
            h = (h ^ shifted) * np.uint32(_MULTIPLIERS[j])
            h ^= h >> np.uint32(15)
            blank &= shifted == 32
        bucket = (h * np.uint32(0x27D4EB2F) >> np.uint32(17)).astype(np.int64)
        bucket[blank | (here + order > owner_end)] = BUCKETS
        found.append(bucket)
    return found, starts[:-1]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: dict[str, np.ndarray] = {}
    for batch in batches:
        langs, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        for lang in set(langs):
            own = [t for k, t in zip(langs, texts) if k == lang]
            total = counts.setdefault(lang, np.zeros(BUCKETS + 1, dtype=np.int64))
            for a, b in _chunks(own):
                for bucket in _buckets(own[a:b])[0]:
                    total += np.bincount(bucket, minlength=BUCKETS + 1)
    for lang, total in counts.items():
        used = np.nonzero(total[:BUCKETS])[0]
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(used), pa.string()), pa.array(used, pa.int32()), pa.array(total[used])],
            names=["lang", "bucket", "n"])


def learn(labelled: DataFrame, per_lang: int = PER_LANG) -> tuple[list[str], np.ndarray]:
    """Languages in order and their log probabilities, from rows of doc_id, text, lang.

    About ``per_lang`` documents of each language are used, chosen by a hash of the id.
    """
    spark = labelled.sparkSession
    small_batches(spark)
    rows = labelled.where("text is not null and lang is not null and doc_id is not null").select(
        "doc_id", "text", "lang")
    sizes = rows.groupBy("lang").agg(F.count("*").alias("size"))
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / float(1 << 30)
    sample = rows.join(sizes, "lang").where(place * F.col("size") < per_lang).select("lang", "text")
    # the sample is bounded, so a fixed number of tasks will do and keeps the partial counts few
    counts = sample.repartition(16).mapInArrow(_count, "lang string, bucket int, n long")
    total = counts.groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    seen = [r[0] for r in sizes.select("lang").limit(MOST_LANGS + 1).collect()]
    if len(seen) > MOST_LANGS:
        raise ValueError(f"more than {MOST_LANGS} languages: the model would not have a bounded size")
    langs = sorted(seen)
    table = np.zeros((len(langs), BUCKETS), dtype=np.float64)
    at = {lang: i for i, lang in enumerate(langs)}
    found = total.toPandas()
    table[found["lang"].map(at).to_numpy(dtype=int), found["bucket"].to_numpy(dtype=int)] = found["n"]
    table += SMOOTHING
    logs = np.log(table / table.sum(axis=1, keepdims=True))
    return langs, np.hstack([logs, np.zeros((len(langs), 1))]).astype(np.float32)


def score(texts: list[str | None], langs: list[str], logs: np.ndarray) -> tuple[list[str], np.ndarray]:
    """The most probable language and its posterior for each text."""
    best, posterior = ["und"] * len(texts), np.zeros(len(texts))
    use = [i for i, t in enumerate(texts) if t and langs and any(map(str.isalpha, t))]
    own = [texts[i] for i in use]
    for a, b in _chunks(own):
        found, starts = _buckets(own[a:b])
        total = np.zeros((len(langs), b - a))
        for row, weights in zip(total, logs):
            for bucket in found:
                row += np.add.reduceat(weights[bucket], starts, dtype=np.float64)
        likely = np.exp(total - total.max(axis=0))
        likely /= likely.sum(axis=0)
        for k, top in enumerate(total.argmax(axis=0)):
            best[use[a + k]], posterior[use[a + k]] = langs[top], likely[top, k]
    return best, posterior


def predict(docs: DataFrame, model: tuple[list[str], np.ndarray], columns: list[str]) -> DataFrame:
    """``columns`` of ``docs`` with lang_pred and score, for every row."""
    spark = docs.sparkSession
    small_batches(spark)
    shared = spark.sparkContext.broadcast(model)
    source = docs.select(*columns, F.col("text").alias("_text"))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema[:-1])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        langs, logs = shared.value
        for batch in batches:
            best, posterior = score(batch.column(len(columns)).to_pylist(), langs, logs)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(best, pa.string()), pa.array(posterior)],
                names=[*columns, "lang_pred", "score"])

    return source.mapInArrow(run, f"{kinds}, lang_pred string, score double")


def identify(docs: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Learn from the documents that are not held out, then predict every document."""
    model = learn(docs.where(~held_out(F.col("doc_id"))))
    marked = docs.select("doc_id", "text", *(columns or []), held_out(F.col("doc_id")).alias("held_out"))
    return predict(marked, model, ["doc_id", *(columns or []), "held_out"])
