"""Suffix-array dedup with a run-length index: bytes that repeat a passage of an earlier document go.

Any two equal passages of ``LENGTH`` bytes have the same smallest hashed k-gram (their anchor). So passages
are dealt by anchor, and both copies meet in one task:

1. Documents are dealt into buckets. Each bucket sends the hashes of its anchors, as packed arrays by segment
   of the hash range; a segment answers with one bit for each: is the anchor in a second document? A second bit tells
   anchors with more than about ``HOT`` windows in all: theirs are cut into single passages, which are dealt by their own
   hash, so that no group depends on how many neighbours a common phrase has.
2. Buckets send the distinct windows around such anchors (all passages that start between two changes of the
   anchor) with the smallest document that has it in the bucket.
3. A segment builds a run-compressed Burrows-Wheeler transform of its distinct windows (without those that are alone
   with their anchor, as equal passages have one anchor): run heads, run starts, character counts at the runs and a
   sample at each run end. The runs are also cut where neighbouring suffixes share less than ``LENGTH`` bytes, and
   each holds the smallest document below it. Windows are streamed through the index from their ends by LF steps over
   the runs; where the matching statistic reaches ``LENGTH`` the samples give the smallest document that has the
   passage. The answer is one bit a passage: does a document before the bucket's own have it?
4. Buckets apply the bits to each of their documents and cut the bytes.

Texts are shuffled once; their windows are hashed in each of the steps 1, 2 and 4. What is sent grows with the
number of anchors (about one in 14 bytes, 4 bytes each) and with the repeated passages; a passage that a third of all
documents share is sent once by each bucket.

Defined results: a null text counts as empty. Rows without doc_id come before all others. Rows of one doc_id
do not count as repeats of each other. Bytes are judged on the input; removed ones may be part of a character.
Other columns are ignored by ``removed_bytes`` and kept by ``cut``. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from tidemill.llm.common import mix64, parts_for, small_batches, text_bytes

LENGTH = 50
GRAM = 24
#: Text of a bucket, and of the texts that make the windows of a segment.
BUCKET_BYTES = 4 << 20
SEGMENT_BYTES = 2 << 20
#: Windows of one anchor that a segment takes whole.
HOT = 4096
_CHUNK = 1 << 19
_U = np.uint64
_NO_ID = np.iinfo(np.int64).min
_SEP = 0  # window ends in the index; bytes are shifted by one
_PACK = 7  # symbols of 9 bits in a word


def _chunks(sizes: list[int]) -> Iterator[tuple[int, int]]:
    start = total = 0
    for i, size in enumerate(sizes):
        if total and total + size > _CHUNK:
            yield start, i
            start, total = i, 0
        total += size
    if start < len(sizes):
        yield start, len(sizes)


def _words_at(data: np.ndarray, n: int) -> np.ndarray:
    """The 8 bytes that follow each of the first ``n`` places, as a number."""
    out = np.empty(n, dtype=np.uint64)
    for r in range(8):
        own = out[r::8]
        own[:] = np.frombuffer(data.data, dtype="<u8", offset=r, count=len(own)) if len(own) else own
    return out


def _grams(data: np.ndarray, n: int) -> np.ndarray:
    """Hash of the ``GRAM`` bytes at each of the first ``n`` places."""
    word = _words_at(data, n + GRAM - 8)
    h = word[:n] * _U(0x9E3779B97F4A7C15)
    for j in range(8, GRAM, 8):
        h = (h ^ (h >> _U(29)) ^ word[j:j + n]) * _U(0xD6E8FEB86659FD93)
    return mix64(h)


def _window_min(h: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each run of ``width`` values."""
    done, out = 1, h
    while done * 2 <= width:
        out = np.minimum(out[:-done], out[done:])
        done *= 2
    rest = width - done
    return np.minimum(out[:len(out) - rest], out[rest:]) if rest else out


class Windows:
    """Windows of a chunk of documents: ``anchor`` hash, ``start`` and number of passages, owner."""

    def __init__(self, texts: list[bytes]):
        sizes = np.array([len(t) for t in texts], dtype=np.int64)
        offsets = np.concatenate([[0], np.cumsum(sizes)])
        self.data = np.frombuffer(b"".join(texts) + bytes(GRAM + 16), dtype=np.uint8)
        n = int(offsets[-1])
        self.n, self.offsets = n, offsets
        if n < LENGTH:
            self.anchor = np.zeros(0, dtype=np.uint64)
            self.start = self.count = self.owner = np.zeros(0, dtype=np.int64)
            return
        least = _window_min(_grams(self.data, n - GRAM + 1), LENGTH - GRAM + 1)
        # a passage must end inside its document
        owner = np.repeat(np.arange(len(texts)), sizes)[:len(least)]
        inside = np.arange(len(least)) + LENGTH <= offsets[owner + 1]
        new = np.concatenate([[True], (least[1:] != least[:-1]) | (owner[1:] != owner[:-1]) | ~inside[:-1]])
        # a very long stretch with one anchor is cut at places that depend on its start
        start = np.flatnonzero(new & inside)
        stop = np.minimum(np.append(start[1:], len(least)), offsets[owner[start] + 1] - LENGTH + 1) if len(start) else start
        # minima are small numbers: scrambled again, they spread over the segments
        self.anchor, self.start, self.count, self.owner = mix64(least[start]), start, stop - start, owner[start]
        self._split()

    def _split(self) -> None:
        """Bound the passages of a window by the width of the anchor's search (runs of one byte exceed it)."""
        most = LENGTH - GRAM + 1
        pieces = -(-self.count // most)
        if len(pieces) and pieces.max() > 1:
            which = np.repeat(np.arange(len(pieces)), pieces)
            step = np.arange(len(which)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            start = self.start[which] + step * most
            count = np.minimum(self.count[which] - step * most, most)
            self.anchor, self.start, self.count, self.owner = self.anchor[which], start, count, self.owner[which]

    def names(self, start: np.ndarray, count: np.ndarray) -> np.ndarray:
        """A hash of the bytes of each of the windows that ``start`` and ``count`` give."""
        if not len(start):
            return np.zeros(0, dtype=np.uint64)
        base = _U(0x5851F42D4C957F2D)
        power = _powers(len(self.data))
        sums = np.concatenate([np.zeros(1, np.uint64), np.add.accumulate(_byte[self.data] * power)])
        stop = start + count + LENGTH - 1
        # bring both ends to one power instead of dividing
        value = (sums[stop] - sums[start]) * _inverses(len(self.data))[start]
        return mix64(value + count.astype(np.uint64) * base)


_byte = mix64(np.arange(1, 257, dtype=np.uint64) * _U(0xA0761D6478BD642F))
_tables: dict[int, np.ndarray] = {}
_BASE = 0x2545F4914F6CDD1D


def _table(base: int, n: int) -> np.ndarray:
    have = _tables.get(base)
    if have is None or len(have) < n:
        steps = np.full(max(n, _CHUNK), base, dtype=np.uint64)
        steps[0] = 1
        have = _tables[base] = np.multiply.accumulate(steps)
    return have[:n]


def _powers(n: int) -> np.ndarray:
    return _table(_BASE, n)


def _inverses(n: int) -> np.ndarray:
    return _table(pow(_BASE, -1, 1 << 64), n)


def _segment(anchor: np.ndarray, segments: int) -> np.ndarray:
    return ((anchor >> _U(32)) * _U(segments) >> _U(32)).astype(np.int64)


def _order(table: pa.Table) -> list[int]:
    """The rows of a bucket by id and text."""
    ids = [_NO_ID if i is None else i for i in table["own_id"].to_pylist()]
    texts = table["own_text"].to_pylist()
    return sorted(range(len(ids)), key=lambda i: (ids[i], texts[i]))


def _ordered(table: pa.Table) -> tuple[np.ndarray, list[bytes]]:
    """Ids and texts of a bucket in order."""
    table = table.select(["own_id", "own_text"]).take(pa.array(_order(table), pa.int64()))
    ids = [_NO_ID if i is None else i for i in table["own_id"].to_pylist()]
    return np.array(ids, dtype=np.int64), table["own_text"].to_pylist()


def _bucket_windows(ids: np.ndarray, texts: list[bytes]) -> Iterator[tuple[int, Windows, np.ndarray]]:
    for a, b in _chunks([len(t) for t in texts]):
        found = Windows(texts[a:b])
        yield a, found, ids[a:b][found.owner] if len(found.owner) else np.zeros(0, dtype=np.int64)


def _groups(sorted_keys: np.ndarray) -> np.ndarray:
    """Where each run of equal keys starts."""
    if not len(sorted_keys):
        return np.zeros(0, dtype=np.int64)
    return np.flatnonzero(np.concatenate([[True], sorted_keys[1:] != sorted_keys[:-1]]))


_ASK = "segment long, bucket long, hashes binary, several binary, weights binary"
_ANSWER = "bucket long, segment long, bits binary, hot binary"
_SEND = "segment long, bucket long, lengths binary, docs binary, bytes binary"


def _distinct_anchors(chunks: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The anchors of a bucket in order, whether two of its documents have each, and the logarithm of its windows."""
    if not chunks:
        return np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=bool), np.zeros(0, dtype=np.uint8)
    h = np.concatenate([found.anchor for _, found, _ in chunks])
    doc = np.concatenate([doc for *_, doc in chunks])
    order = np.argsort(h)
    h, doc = h[order], doc[order]
    at = _groups(h)
    if not len(at):
        return h, np.zeros(0, dtype=bool), np.zeros(0, dtype=np.uint8)
    weight = np.ceil(np.log2(np.diff(np.append(at, len(h))))).astype(np.uint8)
    return h[at], np.minimum.reduceat(doc, at) != np.maximum.reduceat(doc, at), weight


def _cuts(segment: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = _groups(segment)
    return at, np.append(at[1:], len(segment))


def _ask(segments: int):
    def run(table: pa.Table) -> pa.Table:
        hashes, several, weight = _distinct_anchors(list(_bucket_windows(*_ordered(table))))
        segment = _segment(hashes, segments)
        at, stop = _cuts(segment)
        rows = [(int(segment[a]), hashes[a:b].astype(np.uint32).tobytes(), np.packbits(several[a:b]).tobytes(),
                 weight[a:b].tobytes()) for a, b in zip(at, stop)]
        bucket = table["bucket"][0].as_py()
        return pa.table({
            "segment": pa.array([r[0] for r in rows], pa.int64()), "bucket": pa.array([bucket] * len(rows), pa.int64()),
            "hashes": pa.array([r[1] for r in rows], pa.binary()), "several": pa.array([r[2] for r in rows], pa.binary()),
            "weights": pa.array([r[3] for r in rows], pa.binary())})
    return run


def _answer(most: int):
    """Two bits for each anchor that a bucket asked about: is it in a second document, and has it more than about ``most`` windows?"""
    def run(table: pa.Table) -> pa.Table:
        weight = np.frombuffer(b"".join(table["weights"].to_pylist()), dtype=np.uint8)
        asked = [np.frombuffer(h, dtype=np.uint32) for h in table["hashes"].to_pylist()]
        several = [np.unpackbits(np.frombuffer(s, dtype=np.uint8), count=len(h)).astype(bool)
                   for s, h in zip(table["several"].to_pylist(), asked)]
        sizes = [len(h) for h in asked]
        h, flag = np.concatenate(asked), np.concatenate(several)
        order = np.argsort(h, kind="stable")
        at = _groups(h[order])
        length = np.diff(np.append(at, len(h)))
        shared = (length > 1) | np.logical_or.reduceat(flag[order], at)
        bits = np.empty(len(h), dtype=bool)
        bits[order] = np.repeat(shared, length)
        hot = np.empty(len(h), dtype=bool)
        hot[order] = np.repeat(np.add.reduceat(np.int64(1) << weight[order].astype(np.int64), at) > most, length)
        ends = np.cumsum(sizes)
        return pa.table({"bucket": table["bucket"], "segment": table["segment"], **{name: pa.array(
            [np.packbits(b[e - s:e]).tobytes() for s, e in zip(sizes, ends)], pa.binary())
            for name, b in [("bits", bits), ("hot", hot)]}})
    return run


def _shared_windows(ids: np.ndarray, texts: list[bytes], answers: pa.Table, segments: int):
    """Per chunk: its first document, the windows, the documents, the places of those with a shared anchor, and
    whether it is a hot one."""
    chunks = list(_bucket_windows(ids, texts))
    hashes, *_ = _distinct_anchors(chunks)
    shared, hot = np.zeros(len(hashes), dtype=bool), np.zeros(len(hashes), dtype=bool)
    segment = _segment(hashes, segments)
    for flag, column in [(shared, "bits"), (hot, "hot")]:
        bits = dict(zip(answers["segment"].to_pylist(), answers[column].to_pylist()))
        for a, b in zip(*_cuts(segment)):
            flag[a:b] = np.unpackbits(np.frombuffer(bits[int(segment[a])], dtype=np.uint8), count=b - a).astype(bool)
    keep, hot = hashes[shared], hot[shared]
    for a, found, doc in chunks:
        place = np.minimum(np.searchsorted(keep, found.anchor), max(0, len(keep) - 1))
        use = np.flatnonzero(keep[place] == found.anchor) if len(keep) else np.zeros(0, dtype=np.int64)
        yield a, found, doc, use, hot[place[use]] if len(use) else np.zeros(0, dtype=bool)


class _Distinct:
    """The distinct windows of a bucket, in the order in which they are sent and answered."""

    def __init__(self, ids: np.ndarray, texts: list[bytes], answers: pa.Table, segments: int):
        anchor, name, count, least, spans = [], [], [], [], []
        self.chunks = []
        for a, found, doc, use, hot in _shared_windows(ids, texts, answers, segments):
            # a hot window is cut into its passages; equal passages have one anchor, so all copies are cut
            pieces = np.where(hot, found.count[use], 1)
            step = _gather(np.arange(int(pieces.max(initial=0))), np.zeros(len(use), dtype=np.int64), pieces)
            use, hot = np.repeat(use, pieces), np.repeat(hot, pieces)
            start, size = found.start[use] + step, np.where(hot, 1, found.count[use])
            own = found.names(start, size)
            key = np.where(hot, own, found.anchor[use])
            self.chunks.append((a, start, size, found.owner[use], doc[use], own))
            raw = found.data
            # documents ascend in a bucket: the first place of a window is that of its smallest document
            _, at = np.unique(own, return_index=True)
            anchor.append(key[at])
            name.append(own[at])
            count.append(size[at])
            least.append(doc[use][at])
            starts = start[at]
            spans.append(_gather(raw, starts, count[-1] + LENGTH - 1))
        if not anchor:
            anchor, name, count, least = ([np.zeros(0, dtype=t)] for t in (np.uint64, np.uint64, np.int64, np.int64))
            spans = [np.zeros(0, dtype=np.uint8)]
        anchor, name, count, least = map(np.concatenate, (anchor, name, count, least))
        data = np.concatenate(spans)
        offset = np.cumsum(count + LENGTH - 1) - (count + LENGTH - 1)
        segment = _segment(anchor, segments)
        order = np.lexsort((least, name, segment))
        at = _groups(name[order])
        rows = order[at]
        # a name has one anchor, or is its own key, and so one segment; the first row has the smallest document
        self.segment, self.name, self.count, self.least = segment[rows], name[rows], count[rows], least[rows]
        self.data, self.offset = data, offset[rows]


def _gather(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The slices of ``data`` one after the other."""
    total = int(lengths.sum())
    place = np.arange(total) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    return data[np.repeat(starts, lengths) + place]


def _send(segments: int):
    def run(table: pa.Table, answers: pa.Table) -> pa.Table:
        rows = []
        bucket = 0
        if table.num_rows:
            bucket = table["bucket"][0].as_py()
            own = _Distinct(*_ordered(table), answers, segments)
            for a, b in zip(*_cuts(own.segment)):
                span = _gather(own.data, own.offset[a:b], own.count[a:b] + LENGTH - 1)
                rows.append((int(own.segment[a]), own.count[a:b].astype(np.uint8).tobytes(),
                             own.least[a:b].tobytes(), span.tobytes()))
        columns = list(zip(*rows)) if rows else [[], [], [], []]
        return pa.table({
            "segment": pa.array(columns[0], pa.int64()), "bucket": pa.array([bucket] * len(rows), pa.int64()),
            "lengths": pa.array(columns[1], pa.binary()), "docs": pa.array(columns[2], pa.binary()),
            "bytes": pa.array(columns[3], pa.binary())})
    return run


class RunLengthIndex:
    """A run-compressed Burrows-Wheeler transform of windows, each of which has a document.

    ``heads`` and ``starts`` are the runs of the transform, cut also where suffixes share less than ``LENGTH``
    bytes; ``before`` counts the head's character in the rows above a run, ``first`` the rows of smaller characters.
    ``sample`` is a text place for each run: its end, if the rows of a run, which are equal in ``LENGTH`` bytes, are
    taken in falling order of document. ``run_of`` names the run of a row. ``least`` is the smallest document at the samples of the runs of one block, the
    suffixes that are equal in ``LENGTH`` bytes.
    """

    def __init__(self, data: np.ndarray, lengths: np.ndarray, docs: np.ndarray):
        """``data`` holds the windows one after the other, ``lengths`` bytes each."""
        stops = np.cumsum(lengths + 1)
        text = np.zeros(int(stops[-1]), dtype=np.uint16)
        inside = np.ones(len(text), dtype=bool)
        inside[stops - 1] = False
        text[inside] = data.astype(np.uint16) + np.uint16(1)
        del inside
        n = len(text)
        owner = np.repeat(np.arange(len(lengths), dtype=np.int32), lengths + 1)
        left = (stops[owner] - 1 - np.arange(n)).astype(np.int32)  # bytes of the suffix
        order = self._suffixes(text, left, owner, int(lengths.max()))
        del left
        row = np.empty(n, dtype=np.int64)
        row[order] = np.arange(n)
        self.ends = row[stops - 1]
        del row
        before = order - 1
        before[before < 0] = n - 1
        bwt = text[before].astype(np.int16)
        del before, text
        # equal first bytes: block by the rank after LENGTH symbols
        block = self.prefix[order]
        del self.prefix
        cut = np.concatenate([[True], (bwt[1:] != bwt[:-1]) | (block[1:] != block[:-1])])
        self.starts = np.flatnonzero(cut)
        del cut
        self.heads = bwt[self.starts]
        run_length = np.diff(np.append(self.starts, n))
        self.run_of = np.repeat(np.arange(len(self.starts), dtype=np.int32), run_length)
        by_doc = np.empty(len(docs), dtype=np.int64)
        by_doc[np.argsort(docs, kind="stable")] = np.arange(len(docs))
        self.sample = np.minimum.reduceat((by_doc[owner[order]] << 32) | order, self.starts) & 0xFFFFFFFF
        total = np.bincount(bwt, minlength=258)
        self.first = np.concatenate([[0], np.cumsum(total)])[:258]
        by_head = np.argsort(self.heads, kind="stable")
        counted = np.cumsum(run_length[by_head])
        head = self.heads[by_head]
        at = _groups(head)
        base = np.repeat(np.concatenate([[0], counted])[at], np.diff(np.append(at, len(head))))
        self.before = np.empty(len(head), dtype=np.int64)
        self.before[by_head] = counted - run_length[by_head] - base
        blocks = block[self.starts]
        at = _groups(blocks)
        self.least = np.repeat(np.minimum.reduceat(docs[owner[self.sample]], at), np.diff(np.append(at, len(blocks))))

    def _suffixes(self, text: np.ndarray, left: np.ndarray, owner: np.ndarray, longest: int) -> np.ndarray:
        """The suffix array by doubling. A window's end is a symbol below all others; ends are told apart by
        their place. ``prefix`` keeps the rank by the first ``LENGTH`` symbols."""
        n = len(text)
        padded = np.concatenate([text, np.zeros(_PACK, dtype=text.dtype)])
        key = np.zeros(n, dtype=np.uint64)
        for j in range(_PACK):
            key <<= _U(9)
            key |= np.where(left >= j, padded[j:j + n], text.dtype.type(0))
        order = np.argsort(key)
        groups = _Groups(order, key[order])
        del key, order, padded
        known = _PACK
        while known * 2 <= LENGTH:
            groups.refine(groups.ahead(left, known))
            known *= 2
        # from there to LENGTH exactly: the second half overlaps the first
        groups.refine(groups.ahead(left, LENGTH - known))
        self.prefix, known = groups.rank.copy(), LENGTH
        while known <= longest:
            groups.refine(groups.ahead(left, known))
            known *= 2
        # what is still equal are whole equal suffixes of several windows: in the order of their ends
        groups.refine(lambda rows: owner[rows])
        return groups.order

    def matching(self, lengths: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Stream all windows from their ends. Yields, for the places that have ``LENGTH`` bytes to their right: the
        windows, the place in them, and the smallest document with these bytes."""
        row, place = self.ends.copy(), lengths.astype(np.int64).copy()
        active = np.arange(len(lengths))
        while len(active):
            run = self.run_of[row]
            full = lengths[active] - place >= LENGTH
            if full.any():
                yield active[full], place[full], self.least[run[full]]
            going = place > 0
            active, row, run, place = active[going], row[going], run[going], place[going]
            # one LF step: the row of the suffix that is a byte longer
            row = self.first[self.heads[run]] + self.before[run] + (row - self.starts[run])
            place = place - 1


class _Groups:
    """Suffixes in order of what is known of them; equal ones form a group, named by its first row. Only groups
    of several are sorted again."""

    def __init__(self, order: np.ndarray, key: np.ndarray):
        self.order, n = order, len(order)
        start = _groups(key)
        length = np.diff(np.append(start, n))
        self.of_row = np.repeat(start, length)
        self.rank = np.empty(n, dtype=np.int64)
        self.rank[order] = self.of_row
        self.open = np.flatnonzero(np.repeat(length > 1, length))

    def ahead(self, left: np.ndarray, step: int):
        """The rank of the suffix ``step`` symbols on; 0 if the window ends before."""
        last = len(self.rank) - 1
        return lambda rows: np.where(left[rows] >= step, self.rank[np.minimum(rows + step, last)] + 1, 0)

    def refine(self, next_key) -> None:
        place = self.open
        rows = self.order[place]
        key = (self.of_row[place] << 32) | next_key(rows)
        by = np.argsort(key)
        rows, key = rows[by], key[by]
        start = _groups(key)
        length = np.diff(np.append(start, len(key)))
        self.order[place] = rows
        self.of_row[place] = self.rank[rows] = np.repeat(place[start], length)
        self.open = place[np.repeat(length > 1, length)]


def _anchors(data: np.ndarray, offset: np.ndarray) -> np.ndarray:
    """The anchor of the passage at each of the places, which is that of its window."""
    padded = np.concatenate([data, np.zeros(GRAM + 16, dtype=np.uint8)])
    return _window_min(_grams(padded, len(data) - GRAM + 1), LENGTH - GRAM + 1)[offset]


def _several(keys: np.ndarray) -> np.ndarray:
    """Whether each key occurs more than once."""
    _, group, size = np.unique(keys, return_inverse=True, return_counts=True)
    return size[group] > 1


def _names(data: np.ndarray, offset: np.ndarray, count: np.ndarray) -> np.ndarray:
    """A hash of the bytes of each of some windows that follow each other in ``data``."""
    start = offset - offset[0]
    stop = start + count + LENGTH - 1
    own = data[offset[0]:offset[0] + stop[-1]]
    sums = np.concatenate([np.zeros(1, np.uint64), np.add.accumulate(_byte[own] * _powers(len(own)))])
    return mix64((sums[stop] - sums[start]) * _inverses(len(own) + 1)[start]
                 + count.astype(np.uint64) * _U(0x5851F42D4C957F2D))


def _index(table: pa.Table) -> pa.Table:
    """Build the index of a segment, stream its windows, and answer every bucket."""
    counts = [np.frombuffer(x, dtype=np.uint8).astype(np.int64) for x in table["lengths"].to_pylist()]
    docs = [np.frombuffer(x, dtype=np.int64) for x in table["docs"].to_pylist()]
    sizes = [len(c) for c in counts]
    count, doc = np.concatenate(counts), np.concatenate(docs)
    data = np.frombuffer(b"".join(table["bytes"].to_pylist()), dtype=np.uint8)
    lengths = count + LENGTH - 1
    offset = np.cumsum(lengths) - lengths
    # equal windows of several buckets are one window with the smallest of their documents
    name = np.concatenate([_names(data, offset[a:b], count[a:b]) for a, b in _chunks(lengths.tolist())])
    order = np.lexsort((doc, name))
    at = _groups(name[order])
    group = np.empty(len(name), dtype=np.int64)
    group[order] = np.repeat(np.arange(len(at)), np.diff(np.append(at, len(name))))
    rows = order[at]
    width = int(count.max())
    # a window alone with its anchor has no passage of another one: it needs no index
    least = np.repeat(doc[rows][:, None], width, axis=1)
    met = np.flatnonzero(_several(_anchors(data, offset[rows])))
    if len(met):
        own_length = lengths[rows[met]]
        index = RunLengthIndex(_gather(data, offset[rows[met]], own_length), own_length, doc[rows[met]])
        for window, place, smallest in index.matching(own_length):
            least[met[window], place] = smallest
    ends = np.cumsum(sizes)
    bits = []
    for size, end in zip(sizes, ends):
        own = slice(end - size, end)
        earlier = least[group[own]] < doc[own][:, None]
        used = np.arange(width)[None, :] < count[own][:, None]
        bits.append(np.packbits(earlier[used]).tobytes())
    return pa.table({"bucket": table["bucket"], "segment": table["segment"], "bits": pa.array(bits, pa.binary()),
                     "hot": pa.nulls(table.num_rows, pa.binary())})


def _covered(table: pa.Table, answers: pa.Table, covers: pa.Table, segments: int):
    """The bytes of each document of a bucket, in order, and the mask of those that go."""
    ids, texts = _ordered(table)
    own = _Distinct(ids, texts, answers, segments)
    bits = dict(zip(covers["segment"].to_pylist(), covers["bits"].to_pylist()))
    offset = np.cumsum(own.count) - own.count
    earlier = np.zeros(int(own.count.sum()), dtype=bool)
    for a, b in zip(*_cuts(own.segment)):
        n = int(own.count[a:b].sum())
        earlier[offset[a]:offset[a] + n] = np.unpackbits(
            np.frombuffer(bits[int(own.segment[a])], dtype=np.uint8), count=n).astype(bool)
    by_name = np.argsort(own.name)
    names = own.name[by_name]
    for (a, b), chunk in zip(_chunks([len(t) for t in texts]), own.chunks):
        _, start, count, owner, doc, name = chunk
        sizes = np.array([len(t) for t in texts[a:b]], dtype=np.int64)
        edge = np.zeros(int(sizes.sum()) + 1, dtype=np.int32)
        if len(start):
            row = by_name[np.searchsorted(names, name)]
            # the first document of the bucket goes by the bits; a later one repeats it in any case
            place = _gather(np.arange(len(earlier)), offset[row], count)
            goes = earlier[place] | np.repeat(doc > own.least[row], count)
            at = _gather(np.arange(len(edge)), start, count)[goes]
            np.add.at(edge, at, 1)
            np.add.at(edge, at + LENGTH, -1)
        gone = np.cumsum(edge)[:-1] > 0
        stops = np.cumsum(sizes)
        for i, (size, stop) in enumerate(zip(sizes, stops)):
            yield texts[a + i], gone[stop - size:stop]


_DIGEST = pa.schema([("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()),
                     ("kept_sha256", pa.string()), ("kept", pa.string())])


def _digest(segments: int, carried: list[str], text_too: bool):
    """The carried columns of a bucket's rows and what is left of their texts; characters that lost bytes are left out."""
    def run(table: pa.Table, answers: pa.Table) -> pa.Table:
        rows = []
        if table.num_rows:
            for text, gone in _covered(table, *_both(answers), segments):
                spans = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum()) if len(gone) else 0
                kept = np.frombuffer(text, dtype=np.uint8)[~gone].tobytes()
                rows.append((len(text), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest(),
                             kept.decode("utf-8", "ignore") if text_too else None))
            table = table.take(pa.array(_order(table)))
        columns = list(zip(*rows)) if rows else [[]] * len(_DIGEST)
        own = {f.name: pa.array(c, f.type) for c, f in zip(columns, _DIGEST)}
        return pa.table({**{f"c{i}": table[f"c{i}"] for i in range(len(carried))}, **own})
    return run


def _both(answers: pa.Table) -> tuple[pa.Table, pa.Table]:
    """The answers about anchors, and those about windows."""
    flag = answers["windows"]
    return answers.filter(pc.invert(flag)), answers.filter(flag)


def _cleaned(docs: DataFrame, carried: list[str], text_too: bool) -> DataFrame:
    small_batches(docs.sparkSession)
    total = text_bytes(docs)
    buckets, segments = parts_for(total, BUCKET_BYTES), parts_for(total, SEGMENT_BYTES, 4)
    # carried columns go by number, so that no name can clash
    own = docs.select(F.col("doc_id").cast("long").alias("own_id"), F.coalesce(F.encode("text", "UTF-8"), F.lit(b"")).alias(
        "own_text"), *[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(carried)])
    dealt = own.withColumn("bucket", F.pmod(F.xxhash64("own_id", "own_text"), F.lit(buckets))).repartition(buckets, "bucket")
    asked = dealt.groupBy("bucket").applyInArrow(_ask(segments), _ASK)
    shared = asked.groupBy("segment").applyInArrow(_answer(HOT), _ANSWER).repartition(buckets, "bucket")
    sent = dealt.groupBy("bucket").cogroup(shared.groupBy("bucket")).applyInArrow(_send(segments), _SEND)
    covers = sent.groupBy("segment").applyInArrow(_index, _ANSWER)
    answers = shared.withColumn("windows", F.lit(False)).unionByName(
        covers.repartition(buckets, "bucket").withColumn("windows", F.lit(True)))
    kinds = [f"c{i} {own.schema[f'c{i}'].dataType.simpleString()}" for i in range(len(carried))]
    kinds += ["n_bytes long", "n_removed long", "n_spans long", "kept_sha256 string", "kept string"]
    cleaned = dealt.groupBy("bucket").cogroup(answers.groupBy("bucket")).applyInArrow(
        _digest(segments, carried, text_too), ", ".join(kinds))
    return cleaned.withColumnsRenamed({f"c{i}": c for i, c in enumerate(carried)})


def removed_bytes(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 for every row of ``docs`` (doc_id, text)."""
    return _cleaned(docs, ["doc_id"], False).drop("kept")


def cut(docs: DataFrame) -> DataFrame:
    """``docs`` with the repeated passages cut from ``text``, and n_chars (if there is one) brought in line. A
    character that lost some of its bytes goes as a whole; a null text becomes empty."""
    carried = [c for c in docs.columns if c != "text"]
    found = _cleaned(docs, carried, True)
    numbered = found.toDF(*[f"c{i}" for i in range(len(found.columns))])
    texts = numbered.select(F.col(f"c{len(found.columns) - 1}").alias("text"), *[
        F.col(f"c{i}").alias(c) for i, c in enumerate(carried)])
    if "n_chars" in carried:
        texts = texts.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return texts.select(*[f"`{c}`" for c in docs.columns])
