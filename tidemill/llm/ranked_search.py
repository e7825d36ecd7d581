"""Ranked lexical search: the best documents of each item by impact lists and the Best Position Algorithm.

The items are the stated query set. They are taken in blocks of ``ITEM_BYTES`` of text; a block's terms, and only
they, are looked up in the documents. Of every document is kept its number of terms and, of the block's terms, how
often each occurs; that table is written, and the corpus counts are summed from it over all documents.

Documents are then searched in blocks of ``POSTINGS``. A block holds, for each term, its documents by falling impact
and, for each document, the places it has in these lists. The lists of an item are read downwards in parallel; a
document met for the first time is looked up in all other lists, which marks its places there as seen. The best
position of a list is the last one before which everything is seen, by reading or by look-up. What no document
unmet can exceed is the sum of impacts at the best positions; an item is done when that is strictly below its
k-th score, so that equal scores are still found. The k-th score carries over from block to block in a task.

Defined results: terms are compared by 64-bit hashes. Null and empty texts have no terms: such documents count for
nothing, such items have no rows. Every row of documents is a document of its own, also with a repeated or null id
(null after all others among equal scores), and every row of items an item of its own. Scores of 0 are not listed.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from tidemill.llm import words
from tidemill.llm.common import parts_for, stored, text_bytes

ITEM_BYTES = 16 << 20
POSTINGS = 1 << 21
#: Entries read of each list in the first round; twice as many in every further one.
FIRST_READ = 64

_TERM = words.byte_set((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF))


def term_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The hash of every term, A-Z lower-cased, and the text it stands in."""
    data = np.frombuffer(b"".join(t.lower() + b" " for t in texts), dtype=np.uint8)
    starts, ends = words.spans(_TERM[data])
    edges = np.cumsum([0] + [len(t) + 1 for t in texts])
    return words.hashes(data, starts, ends), np.searchsorted(edges, starts, side="right") - 1


@dataclass(frozen=True)
class Items:
    """A block of items: their ids, the sorted hashes of all terms, and of each item its terms with repeats."""

    ids: list
    vocabulary: np.ndarray
    terms: list[np.ndarray]
    repeats: list[np.ndarray]


def items_of(rows: list[tuple]) -> Items:
    """From (item_id, text)."""
    rows = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1] or ""))
    per_item = [np.unique(term_hashes([words.utf8(text)])[0], return_counts=True) for _, text in rows]
    vocabulary = np.unique(np.concatenate([t for t, _ in per_item] or [np.zeros(0, np.uint64)]))
    return Items([r[0] for r in rows], vocabulary, [np.searchsorted(vocabulary, t) for t, _ in per_item],
                 [n for _, n in per_item])


def _occurrences(texts: list[bytes], vocabulary: np.ndarray) -> tuple[np.ndarray, ...]:
    """Of each text the number of its terms and of vocabulary terms; of all texts in turn these terms and counts."""
    found, owner = term_hashes(texts)
    lengths = np.bincount(owner, minlength=len(texts))
    if not len(vocabulary):
        return lengths, np.zeros_like(lengths), np.zeros(0, np.int64), np.zeros(0, np.int64)
    at = np.minimum(np.searchsorted(vocabulary, found), len(vocabulary) - 1)
    known = vocabulary[at] == found
    key, n = np.unique(owner[known] * len(vocabulary) + at[known], return_counts=True)
    return lengths, np.bincount(key // len(vocabulary), minlength=len(texts)), key % len(vocabulary), n


def forward(docs: DataFrame, vocabulary: np.ndarray) -> DataFrame:
    """doc_id, n_terms, and of the vocabulary the terms and counts, for every document with at least one term."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = [words.utf8(t) for t in batch.column(1).to_pylist()]
            for a, b in words.runs(raw):
                lengths, held, terms, counts = _occurrences(raw[a:b], shared.value)
                offsets = np.concatenate([[0], np.cumsum(held)]).astype(np.int32)
                rows = pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), pa.array(lengths.astype(np.int64)),
                     pa.ListArray.from_arrays(offsets, pa.array(terms.astype(np.int32))),
                     pa.ListArray.from_arrays(offsets, pa.array(counts.astype(np.int32)))],
                    names=["doc_id", "n_terms", "terms", "counts"])
                yield rows.filter(pa.array(lengths > 0))

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, n_terms long, terms array<int>, counts array<int>")


def corpus_counts(rows: DataFrame, n_vocabulary: int) -> tuple[int, int, np.ndarray]:
    """Documents, terms in them, and documents that hold each term of the vocabulary."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(n_vocabulary, dtype=np.int64)
        for batch in batches:
            total += np.bincount(np.asarray(batch.column(0).flatten()), minlength=n_vocabulary)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(total[used])], names=["term", "n"])

    n_docs, n_terms = rows.agg(F.count("*"), F.coalesce(F.sum("n_terms"), F.lit(0))).first()
    df = np.zeros(n_vocabulary, dtype=np.int64)
    partial = rows.select("terms").mapInArrow(run, "term int, n long")
    for r in partial.groupBy("term").agg(F.sum("n").alias("n")).toLocalIterator():
        df[r.term] = r.n
    return n_docs, n_terms, df


def term_weights(n_docs: int, df: np.ndarray) -> np.ndarray:
    return np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(n) + 1))) for n in df], dtype=np.int64)


def _ranges(starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """All numbers from each start up to its end."""
    sizes = np.maximum(ends - starts, 0)
    before = np.cumsum(sizes) - sizes
    return np.repeat(starts - before, sizes) + np.arange(sizes.sum())


class Block:
    """The impact lists of some documents, and of each document its places in them."""

    def __init__(self, lengths: np.ndarray, held: np.ndarray, terms: np.ndarray, counts: np.ndarray,
                 n_vocabulary: int, n_docs: int, n_terms: int):
        slowing = 100 - 75 + (75 * lengths * n_docs) // n_terms
        owner = np.repeat(np.arange(len(lengths)), held)
        impact = (1_000_000_000 * counts) // (1000 * counts + 8 * slowing[owner])
        order = np.lexsort((owner, -impact, terms))
        self.list_at = np.concatenate([[0], np.cumsum(np.bincount(terms, minlength=n_vocabulary))])
        self.list_doc, self.list_impact = owner[order], impact[order]
        self.row_at = np.concatenate([[0], np.cumsum(held)])
        self.row_term, self.row_impact = terms, impact
        self.row_place = np.empty(len(order), dtype=np.int64)
        self.row_place[order] = np.arange(len(order))
        self.slot = np.full(n_vocabulary, -1)  # the list of an item that a term has, while that item is searched

    def search(self, terms: np.ndarray, weights: np.ndarray, k: int, kept: np.ndarray
               ) -> tuple[np.ndarray, np.ndarray, int]:
        """Documents of this block that may be among the best, their scores, and how many list entries were read.

        ``kept`` are the best scores of earlier blocks, at most k.
        """
        starts, ends = self.list_at[terms], self.list_at[terms + 1]
        use = (ends > starts) & (weights > 0)
        terms, weights, starts, ends = terms[use], weights[use], starts[use], ends[use]
        self.slot[terms] = np.arange(len(terms))
        seen = np.zeros(len(self.list_doc), dtype=bool)
        met = np.zeros(len(self.row_at) - 1, dtype=bool)
        best, depth, step, accesses = starts.copy(), 0, FIRST_READ, 0
        found, scores = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        while (best < ends).any():
            docs = self.list_doc[_ranges(np.minimum(starts + depth, ends), np.minimum(starts + depth + step, ends))]
            accesses += len(docs)
            new = np.unique(docs[~met[docs]])
            if len(new):
                met[new] = True
                at = _ranges(self.row_at[new], self.row_at[new + 1])
                slot = self.slot[self.row_term[at]]
                part = np.where(slot >= 0, weights[slot] * self.row_impact[at], 0)
                seen[self.row_place[at[slot >= 0]]] = True
                sizes = self.row_at[new + 1] - self.row_at[new]
                found.append(new)
                scores.append(np.add.reduceat(part, np.cumsum(sizes) - sizes))
                kept = np.sort(np.concatenate([kept, scores[-1]]))[::-1][:k]
            depth, step = depth + step, 2 * step
            self._advance(best, ends, seen)
            most = (weights * self.list_impact[np.maximum(best - 1, starts)])[best < ends].sum()
            if len(kept) == k and most < kept[-1]:
                break
        self.slot[terms] = -1
        found, scores = np.concatenate(found), np.concatenate(scores)
        # equal to the k-th stays: a smaller id may win
        likely = (scores > 0) & (scores >= (kept[-1] if len(kept) == k else 1))
        return found[likely], scores[likely], accesses

    @staticmethod
    def _advance(best: np.ndarray, ends: np.ndarray, seen: np.ndarray) -> None:
        """Move each best position to the first entry of its list that is not seen."""
        for i, (at, end) in enumerate(zip(best, ends)):
            while at < end:
                ahead = seen[at:min(at + 4096, end)]
                first = int(ahead.argmin())
                if not ahead[first]:
                    at += first
                    break
                at += len(ahead)
            best[i] = at


def _blocks(batches: Iterator[pa.RecordBatch], postings: int) -> Iterator[pa.Table]:
    held, size = [], 0
    for batch in batches:
        n = len(batch.column(2).flatten())
        if held and size + n > postings:
            yield pa.Table.from_batches(held)
            held, size = [], 0
        held.append(batch)
        size += n
    if held:
        yield pa.Table.from_batches(held)


def _search(rows: DataFrame, items: Items, k: int, postings: int) -> DataFrame:
    """item, doc_id and score: the best of each task."""
    n_docs, n_terms, df = corpus_counts(rows, len(items.vocabulary))
    weights = term_weights(n_docs, df)
    shared = rows.sparkSession.sparkContext.broadcast(
        [(t, weights[t] * n) for t, n in zip(items.terms, items.repeats)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = shared.value
        ids = [np.zeros(0, np.int64)] * len(wanted)
        absent = [np.zeros(0, bool)] * len(wanted)
        scores = [np.zeros(0, np.int64)] * len(wanted)
        for table in _blocks(batches, postings):
            table = table.combine_chunks()
            lists = table.column("terms").combine_chunks()
            own = pc.fill_null(table.column("doc_id"), 2 ** 63 - 1).to_numpy()
            null = pc.is_null(table.column("doc_id")).to_numpy()
            block = Block(
                table.column("n_terms").to_numpy(), np.asarray(lists.value_lengths()).astype(np.int64),
                np.asarray(lists.flatten()).astype(np.int64),
                np.asarray(table.column("counts").combine_chunks().flatten()).astype(np.int64),
                len(weights), n_docs, n_terms)
            for i, (terms, each) in enumerate(wanted):
                docs, points, _ = block.search(terms, each, k, scores[i])
                points = np.concatenate([scores[i], points])
                all_ids, all_null = np.concatenate([ids[i], own[docs]]), np.concatenate([absent[i], null[docs]])
                first = np.lexsort((all_null, all_ids, -points))[:k]
                ids[i], absent[i], scores[i] = all_ids[first], all_null[first], points[first]
        number = np.repeat(np.arange(len(wanted)), [len(s) for s in scores])
        if len(number):
            yield pa.RecordBatch.from_arrays(
                [pa.array(number, pa.int32()),
                 pa.array(np.concatenate(ids), pa.int64(), mask=np.concatenate(absent)),
                 pa.array(np.concatenate(scores), pa.int64())], names=["item", "doc_id", "score"])

    return rows.select(F.col("doc_id").cast("long"), "n_terms", "terms", "counts").mapInArrow(
        run, "item int, doc_id long, score long")


def best_documents(docs: DataFrame, items: DataFrame, k: int = 10, item_bytes: int = ITEM_BYTES,
                   postings: int = POSTINGS) -> DataFrame:
    """item_id, rank, doc_id, score: the k best documents of each item, equal scores by doc_id."""
    spark = docs.sparkSession
    kind = items.schema["item_id"].dataType.simpleString()
    asked = items.select("item_id", "text").where("text is not null")
    blocks = parts_for(text_bytes(asked), item_bytes, least=1)
    ranked = []
    for number in range(blocks):
        own = asked.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == number)
        block = items_of([(r.item_id, r.text) for r in own.toLocalIterator()])
        rows = stored(forward(docs, block.vocabulary), "forward")
        order = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
        found = _search(rows, block, k, postings).withColumn("rank", F.row_number().over(order)).where(
            F.col("rank") <= k)
        names = spark.createDataFrame(list(enumerate(block.ids)), f"item int, item_id {kind}")
        ranked.append(found.join(names, "item").select("item_id", "rank", "doc_id", "score"))
    return reduce(DataFrame.union, ranked)
