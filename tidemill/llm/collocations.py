"""Phrase collocations: a three-way quicksort of word suffixes, dealt over tasks by their leading words.

A suffix is the run of up to four words that starts at a word and ends with its piece at the latest. Each map task
counts equal suffixes of a few megabytes of text, so that copies travel once, and sends every different one to the
group that its leading two words name. A pair of words that is very frequent is a hot one: its suffixes are dealt by
three words, those of a hot triple by all four, so that no group gathers what a frequent word starts.

In a group, pointers to the suffixes are sorted by multikey quicksort: every partition is divided into smaller, equal
and greater by one word of a pivot; the equal ones go on to the next word, up to the fourth. The size of a partition of
equal suffixes is the count of the phrase they start with. A partition that is too small to hold a phrase is abandoned
unsorted. All partitions of a group take a step at a time, in numpy. Only the phrases that were dealt over several
groups come out in parts, which a sum by phrase adds up.

Scores follow from joins of the counted phrases with themselves.

Defined results: a null text is empty, a null lang is ``und``; a document without words adds nothing. Every row counts,
repeated ones too; doc_id plays no part and may be null. Words are compared as a whole (hashes only deal them out).
A text is cut between pieces where it is long; one piece is held as a whole. Ties in rank go by count, then phrase.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemill.llm import words
from tidemill.llm.common import mix64, parts_for, stored

LONGEST = 4
#: Bytes of text of one language whose equal suffixes are combined before they travel.
CHUNK = 4 << 20
#: Suffixes of a group, on average; a prefix with so many words after it may be hot.
GROUP = 1 << 18
#: A prefix with less than one in so many of all suffixes is never hot, which bounds the list of hot ones.
RAREST_HOT = 1 << 17
#: Suffixes that are written as lines at a time.
_AT_ONCE = 1 << 14
#: Groups whose suffixes of a chunk travel in one batch.
_PIECES = 64

_BREAK = words.byte_set((0x0A, 0x0D), (0x21, 0x21), (0x2C, 0x2C), (0x2E, 0x2E), (0x3A, 0x3B), (0x3F, 0x3F))
_IN_WORD = ~(_BREAK | words.byte_set((0x09, 0x09), (0x20, 0x20)))
_U = np.uint64
_SPACE, _LINE = 32, 10


def _cut(text: bytes, size: int) -> Iterator[bytes]:
    """A text in parts of about ``size`` bytes that begin and end with whole pieces."""
    if len(text) <= size:
        yield text
        return
    breaks = np.flatnonzero(_BREAK[np.frombuffer(text, dtype=np.uint8)])
    start = 0
    while len(text) - start > size:
        at = np.searchsorted(breaks, start + size, side="right") - 1
        if at < 0 or breaks[at] < start:  # a piece longer than that
            at += 1
            if at == len(breaks):
                break
        yield text[start:breaks[at] + 1]
        start = int(breaks[at]) + 1
    yield text[start:]


def _chunks(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[str, list[bytes]]]:
    """Texts of one language, about ``size`` bytes of them, from rows of lang and text."""
    held: dict[str, list[bytes]] = {}
    sizes: dict[str, int] = {}
    total = 0
    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            for part in _cut(words.utf8(text).lower(), size):
                if sizes.get(lang, 0) + len(part) > size and lang in held:
                    total -= sizes.pop(lang)
                    yield lang, held.pop(lang)
                held.setdefault(lang, []).append(part)
                sizes[lang] = sizes.get(lang, 0) + len(part) + 1
                total += len(part) + 1
                if total > 4 * size:  # many languages at once: make room
                    yield from held.items()
                    held, sizes, total = {}, {}, 0
    yield from held.items()


def _joint(high: np.ndarray, low: np.ndarray) -> np.ndarray:
    """One number for each pair of numbers."""
    high, span = high.astype(np.int64), int(low.max(initial=0)) + 1
    if (int(high.max(initial=0)) + 1) * span >= 1 << 63:
        high, low = (np.unique(x, return_inverse=True)[1] for x in (high, low))
        span = len(low) + 1
    return high * span + low


class Suffixes:
    """The different suffixes of some texts of one language, with how often each occurs."""

    def __init__(self, texts: list[bytes], lang: str):
        data = np.frombuffer(b"\n".join(texts) + b"\n", dtype=np.uint8)
        in_word = _IN_WORD[data]
        starts, ends = words.spans(in_word)
        sizes = ends - starts
        offsets = np.concatenate([[0], np.cumsum(sizes)])
        held = pa.Array.from_buffers(
            pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(data[in_word])])
        coded = held.dictionary_encode()
        code = np.asarray(coded.indices)
        self.words = coded.dictionary
        self.word_counts = np.bincount(code, minlength=len(self.words))
        del held, coded

        # the words one after another, a space behind each
        in_word[ends] = True
        self.text = data[in_word]
        self.word_at = offsets + np.arange(len(offsets))
        self.text[self.word_at[1:] - 1] = _SPACE

        piece = np.searchsorted(np.flatnonzero(_BREAK[data]), starts)
        del data, in_word, starts, ends, sizes, offsets
        length = np.ones(len(piece), dtype=np.int64)
        for k in range(1, LONGEST):
            length[:-k] += piece[k:] == piece[:-k]
        del piece
        first = np.flatnonzero(length > 1)
        length = length[first]
        padded = np.concatenate([code + 1, np.zeros(LONGEST, code.dtype)])
        each = [padded[first], padded[first + 1]] + [
            np.where(length > k, padded[first + k], code.dtype.type(0)) for k in range(2, LONGEST)]
        del code, padded
        key = _joint(_joint(each[0], each[1]), _joint(each[2], each[3]))
        _, one, self.n = np.unique(key, return_index=True, return_counts=True)
        del key
        self.first, self.length = first[one], length[one]
        del first, length
        self.prefix = self._prefixes([e[one] for e in each], lang)

    def _prefixes(self, codes: list[np.ndarray], lang: str) -> list[np.ndarray]:
        """Hashes of the first two, three and four words; a prefix past the end is that of the whole."""
        own = np.frombuffer(lang.encode(), dtype=np.uint8)
        seed = words.hashes(np.append(own, 0), np.array([0]), np.array([len(own)]))[0]
        buffers = self.words.buffers()
        at = np.frombuffer(buffers[1], dtype=np.int64)[:len(self.words) + 1]
        raw = np.frombuffer(buffers[2] or b"", dtype=np.uint8)[:int(at[-1])]
        by_code = np.append(_U(0), words.hashes(raw, at[:-1], at[1:]))
        mixed = mix64(by_code[codes[0]] + seed)
        found = []
        for k in range(1, LONGEST):
            longer = mix64(mixed * _U(0x9E3779B97F4A7C15) + by_code[codes[k]])
            mixed = longer if k == 1 else np.where(self.length > k, longer, mixed)
            found.append(mixed)
        return found

    def dealt(self, hot: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The prefix that names the group of each suffix, and from how many words on its phrases are whole there."""
        name, whole = self.prefix[0].copy(), np.full(len(self.n), 2, dtype=np.int8)
        is_hot = np.ones(len(self.n), dtype=bool)
        for k in (2, 3):
            is_hot &= _among(self.prefix[k - 2], hot)
            whole[is_hot] = k + 1
            is_hot &= self.length > k
            name[is_hot] = self.prefix[k - 1][is_hot]
        return name, whole

    def strings(self, which: np.ndarray) -> bytes:
        """The chosen suffixes, a line each."""
        return b"".join(self._lines(which[a:a + _AT_ONCE]) for a in range(0, len(which), _AT_ONCE))

    def _lines(self, which: np.ndarray) -> bytes:
        begin, stop = self.word_at[self.first[which]], self.word_at[self.first[which] + self.length[which]]
        ends = np.cumsum(stop - begin)
        out = self.text[np.repeat(begin - ends + (stop - begin), stop - begin) + np.arange(ends[-1])]
        out[ends - 1] = _LINE
        return out.tobytes()


def _among(values: np.ndarray, sorted_values: np.ndarray) -> np.ndarray:
    if not len(sorted_values):
        return np.zeros(len(values), dtype=bool)
    at = np.minimum(np.searchsorted(sorted_values, values), len(sorted_values) - 1)
    return sorted_values[at] == values


def _lang() -> Column:
    return F.coalesce(F.col("lang").cast("string"), F.lit("und"))


def _word_counts(rows: DataFrame) -> DataFrame:
    """lang, word, n: words of the texts; and with a prefix instead of a word, what may be hot."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, texts in _chunks(batches, CHUNK):
            own = Suffixes(texts, lang)
            least = -(-int(own.n.sum()) // (2 * RAREST_HOT))
            prefixes, counts = [], []
            for k in (2, 3):
                use = own.length >= k
                value, at = np.unique(own.prefix[k - 2][use], return_inverse=True)
                n = np.bincount(at, own.n[use], minlength=len(value)).astype(np.int64)
                often = n >= max(least, 2)
                prefixes.append(value[often])
                counts.append(n[often])
            prefix = np.concatenate(prefixes).view(np.int64)
            m = len(own.words)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * (m + len(prefix)), pa.string()),
                 pa.concat_arrays([own.words.cast(pa.large_string()).cast(pa.string()),
                                   pa.nulls(len(prefix), pa.string())]),
                 pa.array(np.concatenate([np.zeros(m, np.int64), prefix])),
                 pa.array(np.concatenate([own.word_counts, *counts]).astype(np.int64))],
                names=["lang", "word", "prefix", "n"])
            del own, texts, use, value, at, n, often, prefixes, counts, prefix  # before the next ones are built

    partial = rows.mapInArrow(run, "lang string, word string, prefix long, n long")
    return partial.groupBy("lang", "word", "prefix").agg(F.sum("n").alias("n"))


def _deal(rows: DataFrame, hot: np.ndarray, groups: int) -> DataFrame:
    """lang, part and the suffixes of a chunk that go there: lines of words, their counts, from where phrases are whole."""
    shared = rows.sparkSession.sparkContext.broadcast(hot)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, texts in _chunks(batches, CHUNK):
            own = Suffixes(texts, lang)
            if not len(own.n):
                continue
            name, whole = own.dealt(shared.value)
            part = (name % _U(groups)).astype(np.int64)
            order = np.argsort(part, kind="stable")
            edges = np.flatnonzero(np.diff(part[order], prepend=-1, append=-1))
            pieces, parts = [order[a:b] for a, b in zip(edges[:-1], edges[1:])], part[order][edges[:-1]]
            for a in range(0, len(pieces), _PIECES):
                own_pieces = pieces[a:a + _PIECES]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(own_pieces), pa.string()), pa.array(parts[a:a + _PIECES]),
                     pa.array([own.strings(p) for p in own_pieces], pa.binary()),
                     pa.array([own.n[p].astype("<i8").tobytes() for p in own_pieces], pa.binary()),
                     pa.array([whole[p].tobytes() for p in own_pieces], pa.binary())],
                    names=["lang", "part", "suffixes", "n", "whole"])
            del own, texts, name, whole, part, order, pieces, own_pieces  # before the next ones are built

    return rows.mapInArrow(run, "lang string, part long, suffixes binary, n binary, whole binary")


def sort_suffixes(code: np.ndarray, n: np.ndarray, whole: np.ndarray, least: int) -> Iterator[tuple[np.ndarray, ...]]:
    """Multikey three-way quicksort of rows of word codes (-1 past the end): a suffix, a length and a count of each phrase.

    Phrases of two words or more come out: those that are whole here if they occur ``least`` times, others always.
    """
    pointer = np.arange(len(n))
    depth = np.zeros(min(len(n), 1), dtype=np.int64)   # of each partition, the word at which its suffixes may differ
    begin = np.array([0, len(n)] if len(n) else [0])
    while len(depth):
        size = np.diff(begin)
        owner = np.repeat(np.arange(len(depth)), size)
        word = code[pointer, depth[owner]]
        pivot = word[begin[:-1] + size // 2][owner]
        side = (word >= pivot).astype(np.int64) + (word > pivot)
        target = 3 * owner + side
        sizes = np.bincount(target, minlength=3 * len(depth))
        pointer = pointer[_stable_places(owner, side, sizes)]
        parts = np.flatnonzero(sizes)
        equal, at_depth = parts % 3 == 1, depth[parts // 3]
        starts = (np.cumsum(sizes) - sizes)[parts]
        weight = np.add.reduceat(n[pointer], starts)
        whole_from = np.maximum.reduceat(whole[pointer], starts)
        length = at_depth + 1
        told = equal & (length >= 2) & ((weight >= least) | (whole_from > length))
        yield pointer[starts[told]], length[told], weight[told]
        # what is left to tell in a partition are phrases of so many words or more
        left = np.maximum(length + equal, 2)
        goes_on = (left <= LONGEST) & ((weight >= least) | (whole_from > left))
        keep = np.repeat(goes_on, sizes[parts])
        member = np.repeat(np.arange(len(parts)), sizes[parts])[keep]
        pointer, depth = pointer[keep], (at_depth + equal)
        # of equal suffixes, those that end here have no further word
        longer = code[pointer, depth[member]] >= 0
        pointer, member = pointer[longer], member[longer]
        kept, begin = np.unique(member, return_index=True)
        depth, begin = depth[kept], np.append(begin, len(pointer))


def _stable_places(owner: np.ndarray, side: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """For each place in the new order the element that goes there: by partition, then side."""
    by_side = sizes.reshape(-1, 3)
    begin = (np.cumsum(sizes) - sizes).reshape(-1, 3)
    places = np.empty(len(owner), dtype=np.int64)
    for k in range(3):
        own = np.flatnonzero(side == k)
        before = np.cumsum(by_side[:, k]) - by_side[:, k]
        of = owner[own]
        places[begin[of, k] + np.arange(len(own)) - before[of]] = own
    return places


def _read(table: pa.Table) -> tuple[np.ndarray, pa.Array, np.ndarray, np.ndarray]:
    """The suffixes of a group: codes by word, the words, counts, and from where phrases are whole."""
    lines, n, whole = (b"".join(table.column(c).to_pylist()) for c in ("suffixes", "n", "whole"))
    data = np.frombuffer(lines, dtype=np.uint8)
    ends = np.flatnonzero((data == _SPACE) | (data == _LINE))
    at_line = data[ends] == _LINE
    sizes = np.diff(ends, prepend=-1) - 1
    mark = np.ones(len(data), dtype=bool)
    mark[ends] = False
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    coded = pa.Array.from_buffers(
        pa.large_binary(), len(ends), [None, pa.py_buffer(offsets), pa.py_buffer(data[mark].tobytes())]
    ).dictionary_encode()
    line = np.cumsum(at_line) - at_line
    first = np.flatnonzero(np.diff(line, prepend=-1))
    code = np.full((len(first), LONGEST), -1, dtype=np.int32)
    code[line, np.arange(len(line)) - first[line]] = np.asarray(coded.indices)
    return code, coded.dictionary, np.frombuffer(n, dtype="<i8"), np.frombuffer(whole, dtype=np.int8)


def _phrases(dealt: DataFrame, least: int) -> DataFrame:
    """lang, phrase, words and n, in parts for phrases of several groups."""
    def run(key: tuple, table: pa.Table) -> pa.Table:
        code, held, n, whole = _read(table)
        found = [np.concatenate(x) for x in zip(*sort_suffixes(code, n, whole, least))]
        if not found:
            found = [np.zeros(0, np.int64)] * 3
        at, length, count = found
        names = held.to_pylist()
        phrases = [b" ".join(names[c] for c in row[:k]) for row, k in zip(code[at].tolist(), length.tolist())]
        return pa.table({
            "lang": pa.array([key[0].as_py()] * len(at), pa.string()),
            "phrase": pa.array(phrases, pa.binary()).cast(pa.string()),
            "words": pa.array(length.astype(np.int32)), "n": pa.array(count.astype(np.int64))})

    return dealt.groupBy("lang", "part").applyInArrow(run, "lang string, phrase string, words int, n long")


def counted(docs: DataFrame, least: int) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, words, f) of every phrase of one to four words that occurs ``least`` times, and (lang, n)."""
    rows = docs.select(_lang().alias("lang"), "text").where("text is not null")
    first = stored(_word_counts(rows), "words")
    single = first.where("word is not null")
    totals = single.groupBy("lang").agg(F.sum("n").alias("n"))
    total = totals.agg(F.sum("n")).first()[0] or 0
    hottest = max(GROUP // 2, total // RAREST_HOT)
    hot = np.array([r.prefix for r in first.where(F.col("word").isNull() & (F.col("n") >= hottest))
                    .select("prefix").distinct().toLocalIterator()], dtype=np.int64).view(np.uint64)
    dealt = _deal(rows, np.sort(hot), parts_for(total, GROUP, least=1))
    parts = single.select("lang", F.col("word").alias("phrase"), F.lit(1).alias("words"), "n").union(
        _phrases(dealt, least))
    whole = parts.groupBy("lang", "phrase", "words").agg(F.sum("n").alias("f")).where(F.col("f") >= least)
    return stored(whole, "phrases"), totals


def _joined(from_: Column, length: Column) -> Column:
    return F.array_join(F.slice("split", from_, length), " ")


def cut_score() -> Column:
    """floor(2000000 * a / (l + r)), in decimals as the product may pass 64 bits."""
    return F.expr("cast(2000000 as decimal(7,0)) * cast(a as decimal(19,0)) div (l + r)")


def collocations(docs: DataFrame, least: int = 30, top: int = 2000, inside: int = 80) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: of each language the phrases whose weakest cut scores highest.

    A phrase is dropped if a longer candidate that holds it occurs ``inside`` percent as often or more.
    """
    phrases, totals = counted(docs, least)
    candidates = phrases.where("words > 1").withColumn("split", F.split("phrase", " "))
    k = F.col("k")
    cuts = candidates.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("words") - 1))).select(
        "lang", "phrase", F.col("f").alias("a"), "k",
        _joined(F.lit(1), k).alias("left"), _joined(k + 1, F.col("words") - k).alias("right"))
    # the parts of a phrase are as frequent as it is, so they are among the counted ones
    left = phrases.select("lang", F.col("phrase").alias("left"), F.col("f").alias("l"))
    right = phrases.select("lang", F.col("phrase").alias("right"), F.col("f").alias("r"))
    weakest = (
        cuts.join(left, ["lang", "left"]).join(right, ["lang", "right"])
        .groupBy("lang", "phrase", "a").agg(F.min(F.struct(cut_score().alias("score"), "k", "l", "r")).alias("cut")))
    # a phrase inside one that is longer by two is inside one that is longer by one and at least as frequent
    longer = candidates.where("words > 2").select(
        "lang", "f", F.explode(F.array(
            _joined(F.lit(1), F.col("words") - 1), _joined(F.lit(2), F.col("words") - 1))).alias("phrase"))
    covered = longer.groupBy("lang", "phrase").agg(F.max("f").alias("most"))
    kept = weakest.join(covered, ["lang", "phrase"], "left").where(
        F.col("most").isNull() | (F.col("most") * 100 < F.col("a") * inside))
    order = Window.partitionBy("lang").orderBy(F.col("cut.score").desc(), F.col("a").desc(), "phrase")
    ranked = kept.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select(
        "lang", F.col("rank").cast("long"), "phrase", "a", F.col("cut.l"), F.col("cut.r"), "n",
        F.col("cut.score").cast("long").alias("score"))
