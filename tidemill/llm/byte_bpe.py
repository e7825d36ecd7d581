"""Byte-level BPE: ranked merges folded over the bytes of distinct words, and decoding by joining pieces.

The rank map (token bytes -> rank) has a fixed size and is broadcast. A task splits whole texts with the
tokenizer's pattern and folds the merges over each distinct word once: of all neighbouring pieces whose union
is a token, the leftmost of lowest rank is merged, until none is left. Words that were met are remembered, up to
``REMEMBERED`` of them and ``REMEMBERED_BYTES`` in a worker. There is no shuffle.

Special tokens are ordinary text. Null texts count as empty and give no ids. Ids are binary, little-endian unsigned
32-bit integers. Repeated rows are encoded each; an empty table gives an empty result.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from tidemill.llm.common import small_batches

REMEMBERED = 400_000
#: Bytes of remembered words, and the length from which the merges of a word go by a heap.
REMEMBERED_BYTES = 64 << 20
LONG = 100


def read_ranks(path: str) -> dict[bytes, int]:
    """A rank file: base64 of a token and its rank on each line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


def merged(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The ids of a word."""
    whole = ranks.get(word)
    if whole is not None:
        return [whole]
    if len(word) > LONG:
        return _merged_long(word, ranks)
    pieces = [word[i:i + 1] for i in range(len(word))]
    get = ranks.get
    none = len(ranks) + (1 << 31)
    found = [get(a + b, none) for a, b in zip(pieces, pieces[1:])]
    while found:
        best = min(found)
        if best == none:
            break
        i = found.index(best)
        pieces[i:i + 2] = [pieces[i] + pieces[i + 1]]
        del found[i]
        if i:
            found[i - 1] = get(pieces[i - 1] + pieces[i], none)
        if i < len(found):
            found[i] = get(pieces[i] + pieces[i + 1], none)
    return [ranks[p] for p in pieces]


def _merged_long(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same for a word of any length: a merge costs a step in a heap instead of a search of the word."""
    n, get = len(word), ranks.get
    pieces: list[bytes | None] = [word[i:i + 1] for i in range(n)]
    before, after = list(range(-1, n - 1)), list(range(1, n + 1))
    heap = [(rank, i) for i in range(n - 1) if (rank := get(word[i:i + 2])) is not None]
    heapify(heap)
    while heap:
        rank, i = heappop(heap)
        left = pieces[i]
        if left is None or (j := after[i]) == n or get(left + pieces[j]) != rank:
            continue  # one of the two has been merged meanwhile
        pieces[i], pieces[j] = left + pieces[j], None
        after[i] = j = after[j]
        if j < n:
            before[j] = i
            if (rank := get(pieces[i] + pieces[j])) is not None:
                heappush(heap, (rank, i))
        if (h := before[i]) >= 0 and (rank := get(pieces[h] + pieces[i])) is not None:
            heappush(heap, (rank, h))
    return [ranks[p] for p in pieces if p is not None]


class Encoder:
    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks, self.split = ranks, regex.compile(pattern).findall
        self.pieces = [b""] * (max(ranks.values(), default=-1) + 1)
        for token, rank in ranks.items():
            self.pieces[rank] = token
        self.known: dict[str, bytes] = {}
        self.held = 0

    def __call__(self, text: str | None) -> bytes:
        words, known = self.split(text or ""), self.known
        try:
            return b"".join([known[w] for w in words])
        except KeyError:
            pass
        for word in set(words):
            if word not in known:
                raw = word.encode("utf-8", "surrogatepass")
                known[word] = np.array(merged(raw, self.ranks), dtype="<u4").tobytes()
                self.held += len(raw)
        ids = b"".join([known[w] for w in words])
        if len(known) > REMEMBERED or self.held > REMEMBERED_BYTES:
            known.clear()
            self.held = 0
        return ids

    def decode(self, ids: bytes) -> bytes:
        pieces = self.pieces
        return b"".join([pieces[i] for i in np.frombuffer(ids, dtype="<u4").tolist()])


_encoders: dict[int, Encoder] = {}


def _encoder(shared) -> Encoder:
    """The worker's encoder; it outlives a task, and so do the words it remembers."""
    ranks, pattern = shared.value
    if id(ranks) not in _encoders:
        _encoders.clear()
        _encoders[id(ranks)] = Encoder(ranks, pattern)
    return _encoders[id(ranks)]


def _mapped(rows: DataFrame, ranks: dict[bytes, int], pattern: str, added: list[tuple[str, str]], make) -> DataFrame:
    """``rows`` without its last column, which ``make(encoder, values)`` turns into the added columns."""
    spark = rows.sparkSession
    small_batches(spark)
    shared = spark.sparkContext.broadcast((ranks, pattern))
    # columns go by number, so that no name can clash
    carried = rows.columns[:-1]
    numbered = rows.toDF(*[f"c{i}" for i in range(len(carried))], "own")
    kinds = [f"c{i} {f.dataType.simpleString()}" for i, f in enumerate(rows.schema[:-1])] + [f"{n} {k}" for n, k in added]
    names = [f"c{i}" for i in range(len(carried))] + [n for n, _ in added]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(shared)
        for batch in batches:
            columns = make(encoder, batch.column(len(carried)).to_pylist())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *columns], names=names)

    return numbered.mapInArrow(run, ", ".join(kinds)).toDF(*carried, *[n for n, _ in added])


def _encoded(encoder: Encoder, texts: list) -> list[pa.Array]:
    return [pa.array([encoder(t) for t in texts], pa.binary())]


def _decoded(encoder: Encoder, ids: list) -> list[pa.Array]:
    return [pa.array([encoder.decode(i or b"") for i in ids], pa.binary())]


def _there_and_back(encoder: Encoder, texts: list) -> list[pa.Array]:
    ids = [encoder(t) for t in texts]
    return [pa.array(ids, pa.binary()), pa.array([encoder.decode(i) for i in ids], pa.binary())]


def encode(docs: DataFrame, ranks: dict[bytes, int], pattern: str, carried: list[str]) -> DataFrame:
    """``carried`` columns and ids for every row of ``docs`` (text)."""
    return _mapped(docs.select(*carried, "text"), ranks, pattern, [("ids", "binary")], _encoded)


def decode(tokens: DataFrame, ranks: dict[bytes, int], pattern: str, carried: list[str]) -> DataFrame:
    """``carried`` columns and decoded bytes for every row of ``tokens`` (ids)."""
    return _mapped(tokens.select(*carried, "ids"), ranks, pattern, [("decoded", "binary")], _decoded)


def round_trip(docs: DataFrame, ranks: dict[bytes, int], pattern: str, carried: list[str]) -> DataFrame:
    """``encode`` and ``decode`` in one pass: ``carried`` columns, ids, decoded."""
    return _mapped(docs.select(*carried, "text"), ranks, pattern, [("ids", "binary"), ("decoded", "binary")], _there_and_back)


def n_tokens(ids: str = "ids"):
    return (F.octet_length(ids) / 4).cast("long")
