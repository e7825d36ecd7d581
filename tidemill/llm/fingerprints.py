"""Document fingerprints by locally consistent parsing.

A text is cut into phrases by what stands next to a symbol, never by its place: deterministic coin tossing
labels each symbol by the lowest bit in which it differs from the one before, local minima of the labels end
a phrase, and the phrases' names are the symbols of the next level. So equal substrings get equal phrases inside,
wherever they stand. The names of the upper levels are kept as a sketch of ``SLOTS`` minima; likeness is the share of
slots that agree.

Equal texts have equal fingerprints. Null texts count as empty; two empty texts have likeness 1, an empty and another
0. The next document is the next row by (doc_id, text), nulls first, and the first follows the last; repeated rows
follow one another, and a single row follows itself. Other columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from tidemill.llm.common import mix64, parts_for, small_batches, stored, text_bytes

SLOTS = 64
LEVELS = 3
#: Phrases of these levels are in the sketch; a text that is one phrase by then counts with that.
SKETCHED = (2, 3)
BLOCK_BYTES = 32 << 20
MOST_BLOCKS = 2048
_EMPTY = 0xFFFFFFFF
_ROUNDS = 3
_U = np.uint64


def _without_runs(x: np.ndarray) -> np.ndarray:
    """Each run of one symbol becomes a symbol of its own, so that neighbours differ."""
    change = np.flatnonzero(np.concatenate([[True], x[1:] != x[:-1]]))
    length = np.diff(np.append(change, len(x))).astype(np.uint64)
    return mix64(x[change] + length * _U(0x9E3779B97F4A7C15))


def _labels(x: np.ndarray) -> np.ndarray:
    """Coin tossing: small labels of which neighbours differ. The first symbol is compared with a fixed one."""
    for _ in range(_ROUNDS):
        before = np.concatenate([[_U(0) if x[0] != 0 else _U(1)], x[:-1]])
        differ = x ^ before
        low = differ & (~differ + _U(1))
        place = np.log2(low.astype(np.float64)).astype(np.uint64)
        x = place * _U(2) + ((x >> place) & _U(1))
    return x


def _phrases(x: np.ndarray) -> np.ndarray:
    """Names of the phrases of a sequence."""
    x = _without_runs(x)
    if len(x) < 3:
        starts = np.zeros(1, dtype=np.int64)
    else:
        label = _labels(x).astype(np.int64)
        least = (label[1:-1] < label[:-2]) & (label[1:-1] < label[2:])
        starts = np.concatenate([[0], np.flatnonzero(least) + 1])
    length = np.diff(np.append(starts, len(x)))
    place = np.arange(len(x)) - np.repeat(starts, length)
    mixed = mix64(x ^ mix64(place.astype(np.uint64) + _U(0x51ED270B)))
    return mix64(np.add.reduceat(mixed, starts))


def sketch(text: str) -> np.ndarray:
    """``SLOTS`` minima of 32 bits over the phrase names; ``_EMPTY`` in all for an empty text."""
    slots = np.full(SLOTS, _EMPTY, dtype=np.uint32)
    if not text:
        return slots
    x = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.uint64) + _U(1)
    for level in range(1, LEVELS + 1):
        x = _phrases(x)
        if level in SKETCHED or len(x) == 1:
            name = mix64(x + _U(level))
            value = ((name >> _U(16)) % _U(_EMPTY)).astype(np.uint32)
            np.minimum.at(slots, (name & _U(SLOTS - 1)).astype(np.int64), value)
        if len(x) == 1:
            break
    return slots


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    used = (a != _EMPTY) | (b != _EMPTY)
    n = int(used.sum())
    return float((a == b)[used].sum()) / n if n else 1.0


def hexed(slots: np.ndarray) -> str:
    return slots.astype(">u4").tobytes().hex()


def edited(text: str, after: str) -> str:
    n = len(text) // 4
    return text[: len(text) - n] + after[:n]


_SCHEMA = pa.schema([
    ("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
    ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())])


def _follow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted inside their block; the last of a block is the guest that follows it."""
    held = None  # block, doc_id, text, sketch
    for batch in batches:
        rows = []
        for block, guest, doc_id, text in zip(*(c.to_pylist() for c in batch.columns)):
            text = text or ""
            own = sketch(text)
            if held is not None and held[0] == block:
                _, h_id, h_text, h_own = held
                new = edited(h_text, text)
                made = sketch(new)
                rows.append((h_id, len(h_text), hashlib.sha256(new.encode("utf-8", "surrogatepass")).hexdigest(),
                             hexed(h_own), hexed(made), likeness(h_own, made), likeness(h_own, own)))
            held = None if guest else (block, doc_id, text, own)
        columns = list(zip(*rows)) if rows else [[]] * len(_SCHEMA)
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(columns, _SCHEMA)], schema=_SCHEMA)


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next for every row.

    Documents are cut into blocks of ids; the first document of each block also visits the block before it.
    """
    small_batches(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long"), "text")
    blocks = min(MOST_BLOCKS, parts_for(text_bytes(rows), BLOCK_BYTES))
    # blocks are streamed, so the bound on their number costs no memory; bounds is a short list of ids
    steps = [i / blocks for i in range(1, blocks)]
    bounds = sorted(set(rows.approxQuantile("doc_id", steps, 0.2 / blocks))) if blocks > 1 else []
    edges = F.array(*[F.lit(int(b)) for b in bounds]).cast("array<long>")
    block = F.when(F.col("doc_id").isNull(), -1).otherwise(
        F.size(F.filter(edges, lambda e: e < F.col("doc_id")))).cast("int")
    placed = rows.withColumn("block", block)

    # the smallest row of each block: its id first, then the text among rows of that id
    least = placed.groupBy("block").agg(F.min("doc_id").alias("least"))
    heads = placed.join(least.withColumnRenamed("block", "b"), (F.col("block") == F.col("b"))
                        & F.col("doc_id").eqNullSafe(F.col("least")), "left_semi")
    firsts = stored(heads.groupBy("block").agg(
        F.min("doc_id").alias("doc_id"), F.min(F.struct("text")).alias("head")), "fingerprint-heads")
    # one row per block: where the guest goes
    ring = Window.orderBy("block")
    last = firsts.agg(F.max("block")).first()[0]
    guests = firsts.select("doc_id", F.col("head.text").alias("text"), F.coalesce(
        F.lag("block").over(ring), F.lit(last).cast("int")).alias("to"))
    staged = placed.select("block", F.lit(False).alias("guest"), "doc_id", "text").unionByName(
        guests.select(F.col("to").alias("block"), F.lit(True).alias("guest"), "doc_id", "text"))
    dealt = staged.repartition(blocks, "block").sortWithinPartitions(
        "block", "guest", F.col("doc_id").asc_nulls_first(), F.col("text").asc_nulls_first())
    kinds = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
             "near_edited double, near_next double")
    return dealt.mapInArrow(_follow, kinds)
