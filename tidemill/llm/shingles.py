"""Word shingles of many texts at once, as sorted sets of 64-bit hashes.

A-Z are lower-cased; words are runs of anything but space and the characters 9 to 13. A set holds the
distinct shingles of ``size`` words; a text with fewer words is one shingle, a text without words has none.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

from tidemill.llm.common import mix64

_U = np.uint64
_CHUNK = 1 << 19
_BASE = 0x5851F42D4C957F2D
_INVERSE = pow(_BASE, -1, 1 << 64)
_byte = mix64(np.arange(1, 257, dtype=np.uint64) * _U(0x9E3779B97F4A7C15))
_power: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    """base ** 0, 1, 2, ... modulo 2 ** 64."""
    have = _power.get(base)
    if have is None or len(have) < n:
        steps = np.full(max(n, _CHUNK + 1), base, dtype=np.uint64)
        steps[0] = 1
        have = _power[base] = np.multiply.accumulate(steps)
    return have[:n]


def _chunks(texts: list[bytes]) -> Iterator[tuple[int, int]]:
    start = size = 0
    for i, text in enumerate(texts):
        if size and size + len(text) > _CHUNK:
            yield start, i
            start, size = i, 0
        size += len(text) + 1
    if start < len(texts):
        yield start, len(texts)


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, and where the words of each text start (one more at the end)."""
    joined = np.frombuffer(b"".join(t.lower() + b" " for t in texts), dtype=np.uint8)
    blank = (joined == 32) | ((joined >= 9) & (joined <= 13))
    starts = np.flatnonzero(~blank & np.concatenate([[True], blank[:-1]]))
    ends = np.flatnonzero(blank & np.concatenate([[False], ~blank[:-1]]))
    n = len(joined)
    sums = np.concatenate([np.zeros(1, np.uint64), np.add.accumulate(_byte[joined] * _powers(_BASE, n))])
    value = (sums[ends] - sums[starts]) * _powers(_INVERSE, n)[starts]
    value = mix64(value + (ends - starts).astype(np.uint64) * _U(0xC2B2AE3D27D4EB4F))
    offsets = np.cumsum([0] + [len(t) + 1 for t in texts])
    return value, np.searchsorted(starts, offsets)


def shingle_sets(texts: list[str | None], size: int) -> Iterator[np.ndarray]:
    """The sorted set of each text, in order."""
    raw = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
    weights = mix64(np.arange(1, size + 1, dtype=np.uint64)) | _U(1)
    for a, b in _chunks(raw):
        words, places = word_hashes(raw[a:b])
        whole = max(0, len(words) - size + 1)
        mixed = np.zeros(whole, dtype=np.uint64)
        for j in range(size):
            mixed += words[j:j + whole] * weights[j]
        mixed = mix64(mixed)
        for first, last in zip(places[:-1], places[1:]):
            count = last - first
            if count >= size:
                yield np.unique(mixed[first:last - size + 1])
            elif count:
                short = (words[first:last] * weights[:count]).sum(dtype=np.uint64) + _U(count)
                yield mix64(np.array([short], dtype=np.uint64))
            else:
                yield np.zeros(0, dtype=np.uint64)
