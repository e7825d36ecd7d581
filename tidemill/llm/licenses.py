"""License scans by patience alignment.

A template and a stretch of text are aligned word by word: words that occur once in both are anchors, the
longest increasing run of anchors stands, and the gaps between are trimmed at their ends and aligned the
same way. Coverage is the share of the template's words that are matched. A window of the text is aligned only
where enough words of the template occur, which no alignment could exceed, so no match is missed by that.

Windows of 1.25 times the template start at every word of it, and grow while a match goes on at their end. Of the
places found, the one of most coverage stands, then the shorter, then the earlier one; those that overlap it go, and
so on with the rest.

The templates are whole notices of common license families (``notices``); of alike ones, such as those of the GNU
licenses, all that reach the threshold are found, the right one with most coverage.

Every document gives a row for each license found, or one row with a null license and coverage 0. Words
are runs of letters, digits and underscores, lower-cased. A null or empty text has none. Repeated rows are scanned each, null
ids are kept, other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemill.llm.common import small_batches
from tidemill.llm.notices import NOTICES

THRESHOLD = 0.8

# Public license notices.
TEMPLATES = NOTICES

_word = re.compile(r"\w+")
_SCHEMA = pa.schema([("doc_id", pa.int64()), ("license", pa.string()), ("coverage", pa.float64()),
                     ("first_word", pa.int32()), ("last_word", pa.int32()), ("n_found", pa.int32())])


def words(text: str) -> list[str]:
    return _word.findall(text.lower())


def _anchors(a: list, b: list, a0: int, a1: int, b0: int, b1: int) -> list[tuple[int, int]]:
    """Pairs of places of the words that occur once in either range, in increasing order in both."""
    in_a, in_b = Counter(a[a0:a1]), Counter(b[b0:b1])
    place = {b[j]: j for j in range(b0, b1) if in_b[b[j]] == 1}
    pairs = [(i, place[a[i]]) for i in range(a0, a1) if in_a[a[i]] == 1 and a[i] in place]
    ends: list[int] = []
    last: list[int] = []
    back = [-1] * len(pairs)
    for n, (_, j) in enumerate(pairs):
        k = bisect_left(ends, j)
        ends[k:k + 1], last[k:k + 1] = [j], [n]
        back[n] = last[k - 1] if k else -1
    run, n = [], last[-1] if last else -1
    while n >= 0:
        run.append(pairs[n])
        n = back[n]
    return run[::-1]


def align(a: list, b: list) -> list[tuple[int, int]]:
    """Matched places of two word lists, increasing in both."""
    matched: list[tuple[int, int]] = []
    gaps = [(0, len(a), 0, len(b))]
    while gaps:
        a0, a1, b0, b1 = gaps.pop()
        while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
            matched.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            matched.append((a1, b1))
        run = _anchors(a, b, a0, a1, b0, b1) if a0 < a1 and b0 < b1 else []
        if run:
            matched += run
            for (i, j), (i2, j2) in zip([(a0 - 1, b0 - 1), *run], [*run, (a1, b1)]):
                if i + 1 < i2 and j + 1 < j2:
                    gaps.append((i + 1, i2, j + 1, j2))
    return sorted(matched)


class Scanner:
    def __init__(self, templates: dict[str, str], threshold: float = THRESHOLD):
        self.threshold = threshold
        self.ids: dict[str, int] = {}
        self.templates = {}
        for name, text in templates.items():
            own = [self.ids.setdefault(w, len(self.ids) + 1) for w in words(text)]
            member = None
            if own:
                self.templates[name] = (own, member)
        for name, (own, _) in self.templates.items():
            member = np.zeros(len(self.ids) + 1, dtype=np.int32)
            member[own] = 1
            self.templates[name] = (own, member)

    def scan(self, text: str | None) -> list[tuple[str, float, int, int, int]]:
        """license, best coverage, its first and last word, number of places for each license found."""
        get = self.ids.get
        known = np.fromiter((get(w, 0) for w in words(text or "")), dtype=np.int32)
        found = []
        if not known.any():
            return found
        for name, (own, member) in self.templates.items():
            places = self._places(known, own, member)
            if places:
                best = max(places, key=lambda p: (p[0], -p[1]))
                found.append((name, *best, len(places)))
        return found

    def _places(self, known: np.ndarray, own: list[int], member: np.ndarray) -> list[tuple[float, int, int]]:
        m = len(own)
        need = self.threshold * m
        flags = member[known]
        total = np.concatenate([[0], np.cumsum(flags)])
        if total[-1] < need:
            return []
        size = m + _slack(m)
        ends = np.minimum(np.arange(len(known)) + size, len(known))
        starts = np.nonzero((flags == 1) & (total[ends] - total[:-1] >= need))[0].tolist()
        many = np.bincount(own, minlength=len(member))
        hits, free = [], 0
        for start in starts:
            # the words of a window that a template can use, each as often as both have it; 0 stands for all others
            if start < free or np.minimum(np.bincount(known[start:start + size], minlength=len(many)), many).sum() < need:
                continue
            pairs = _aligned(known, start, own, need)
            if len(pairs) >= need:
                first, last = start + pairs[0][0], start + pairs[-1][0]
                hits.append((len(pairs) / m, first, last))
                if len(pairs) == m == last - first + 1:
                    # no place is better than a verbatim one, so those that overlap it need no look
                    free = last + 1
        places, taken = [], np.zeros(len(known), dtype=bool)
        for hit in sorted(hits, key=lambda p: (-p[0], p[2] - p[1], p[1])):
            span = slice(hit[1], hit[2] + 1)
            if not taken[span].any():
                taken[span] = True
                places.append(hit)
        return places


def _slack(m: int) -> int:
    return max(2, m // 4)


def _aligned(known: np.ndarray, start: int, own: list[int], need: float) -> list[tuple[int, int]]:
    """The template aligned from ``start``: a window that has enough of it grows while the match goes on at its end."""
    slack = _slack(len(own))
    stop = start + len(own) + slack
    # words outside the vocabulary all differ from the template's
    pairs = align(known[start:stop].tolist(), own)
    while (need <= len(pairs) and stop < len(known) and pairs[-1][1] + 1 < len(own)
           and start + pairs[-1][0] >= stop - slack):
        longer = align(known[start:stop + slack].tolist(), own)
        if len(longer) <= len(pairs):
            break
        pairs, stop = longer, stop + slack
    return pairs


def scan(docs: DataFrame, templates: dict[str, str] | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, license, coverage, first_word, last_word, n_found for every row of ``docs`` (doc_id, text)."""
    small_batches(docs.sparkSession)
    own = dict(templates or TEMPLATES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(own, threshold)
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found = scanner.scan(text)
                rows += [(doc_id, *f) for f in found] or [(doc_id, None, 0.0, None, None, 0)]
            columns = list(zip(*rows)) if rows else [[]] * len(_SCHEMA)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(columns, _SCHEMA)], schema=_SCHEMA)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        run, "doc_id long, license string, coverage double, first_word int, last_word int, n_found int")
