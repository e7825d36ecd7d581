"""Words of many texts at once: places, owners and hashes, from the bytes of UTF-8."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

from tidemill.llm.common import mix64

_U = np.uint64
#: Bytes that are looked at together; a longer text is a run of its own.
CHUNK = 1 << 20
_BASE = 0x9FB21C651E98DF25
_INVERSE = pow(_BASE, -1, 1 << 64)
_of_byte = mix64(np.arange(1, 257, dtype=np.uint64) * _U(0xD1B54A32D192ED03))
_power: dict[int, np.ndarray] = {}


def utf8(text: str | None) -> bytes:
    """A text in UTF-8, a null as an empty one."""
    return (text or "").encode("utf-8", "surrogatepass")


def byte_set(*ranges: tuple[int, int]) -> np.ndarray:
    """A mark for each byte value that lies in one of the ranges, both ends included."""
    marks = np.zeros(256, dtype=bool)
    for first, last in ranges:
        marks[first:last + 1] = True
    return marks


def runs(texts: list[bytes], size: int = CHUNK) -> Iterator[tuple[int, int]]:
    """Neighbouring texts of about ``size`` bytes in all, as from and to."""
    start = held = 0
    for i, text in enumerate(texts):
        if held and held + len(text) > size:
            yield start, i
            start, held = i, 0
        held += len(text) + 1
    if start < len(texts):
        yield start, len(texts)


def spans(in_word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First byte and end of each word; the last byte must not be of a word."""
    edge = np.diff(in_word.astype(np.int8), prepend=np.int8(0))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def _powers(base: int, n: int) -> np.ndarray:
    """base ** 0, 1, 2, ... modulo 2 ** 64."""
    have = _power.get(base)
    if have is None or len(have) < n:
        steps = np.full(max(n, CHUNK + 1), base, dtype=np.uint64)
        steps[0] = 1
        have = np.multiply.accumulate(steps)
        if n <= 4 * CHUNK:  # those of a giant text are not kept
            _power[base] = have
    return have[:n]


def hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span of bytes, the same wherever the span stands."""
    sums = np.concatenate([np.zeros(1, np.uint64), np.add.accumulate(_of_byte[data] * _powers(_BASE, len(data)))])
    value = (sums[ends] - sums[starts]) * _powers(_INVERSE, len(data) + 1)[starts]
    return mix64(value + (ends - starts).astype(np.uint64) * _U(0x8CB92BA72F3D8DD7))
