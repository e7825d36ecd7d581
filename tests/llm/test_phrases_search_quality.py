"""Collocations, ranked search and the quality classifier against plain versions, also on odd rows."""

import zlib
from collections import Counter

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

import brute
from tidemill.llm import collocations, quality, ranked_search, words
from tidemill.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.01"
LONG = " ".join(f"word{i * i % 977} of the" for i in range(20_000)) + ". " + "no break " * 5000
TEXTS = [
    (1, LONG, "en"), (2, None, "en"), (3, "", None), (4, "?!? 123 ...", "de"), (5, "New York, new york. New York!", "en"),
    (6, "in new york of the", None), (6, "in new york of the", None), (7, "two words", "fr"), (8, "TWO\twords  twice", "fr"),
    (None, "of the people of the town", None), (None, None, None), (9, LONG + " tail", "en"), (10, "x", "de"),
    (11, "ÀÉ ½ \U0001F600 'll z" + "\n" * 40 + "à é ÀÉ ½", "fr"), (12, "a" * 500, "en"), (13, "b " * 3000, "en"),
    (4, "another text of the same number", "de"), (14, "of the of the of the", "und"), (15, "a\x00b c\x1fd\x0be f", "en"),
]
CLASHES = ["word", "prefix", "n", "f", "k", "split", "left", "part", "phrase", "words", "whole", "item", "score", "rank",
           "terms", "counts", "n_terms", "x", "held_out", "total", "source", "n_chars"]


@pytest.fixture(scope="module")
def docs(spark):
    extra = ", ".join(f"`{c}` string" for c in CLASHES)
    return spark.createDataFrame(
        [(*t, *CLASHES) for t in TEXTS], f"doc_id long, text string, lang string, {extra}").repartition(4)


def _plain_collocations(least, top):
    return brute.collocations([{"text": t, "lang": lang} for _, t, lang in TEXTS], least, top)


@pytest.mark.parametrize("chunk, group", [(1 << 22, 1 << 18), (1 << 15, 1 << 12)], ids=["large", "split"])
def test_collocations_of_odd_rows(docs, monkeypatch, chunk, group):
    # small groups make hot pairs and triples, whose counts come in parts
    monkeypatch.setattr(collocations, "CHUNK", chunk)
    monkeypatch.setattr(collocations, "GROUP", group)
    found = [tuple(r) for r in collocations.collocations(docs, 2, 60).collect()]
    assert sorted(found) == sorted(_plain_collocations(2, 60))


def test_hot_prefixes_are_split(monkeypatch):
    own = collocations.Suffixes([words.utf8(LONG)], "en")
    pair = Counter(zip(own.prefix[0].tolist(), own.n.tolist()))
    hot = np.sort(np.array([max(pair, key=pair.get)[0]], dtype=np.uint64))
    name, whole = own.dealt(hot)
    split = own.prefix[0] == hot[0]
    assert split.sum() > 100 and len(np.unique(name[split])) > 100
    assert (whole[split] == 3).all() and (whole[~split] == 2).all() and (name[~split] == own.prefix[0][~split]).all()


def test_no_collocations_in_an_empty_table(docs):
    assert collocations.collocations(docs.limit(0), 2).collect() == []
    assert collocations.collocations(docs.where("text is null"), 2).collect() == []


def test_sorting_counts_prefixes_of_suffixes():
    pick = np.random.default_rng(3)
    for size, kinds, least in ((0, 3, 2), (1, 1, 1), (400, 3, 5), (3000, 40, 4), (500, 1, 30)):
        length = pick.integers(2, 5, size)
        code = pick.integers(0, kinds, (size, 4)).astype(np.int32)
        code[np.arange(4) >= length[:, None]] = -1
        n = pick.integers(1, 4, size)
        want = Counter()
        for row, k, times in zip(code.tolist(), length, n):
            for i in range(2, k + 1):
                want[tuple(row[:i])] += int(times)
        got = {}
        for at, k, times in collocations.sort_suffixes(code, n, np.full(size, 2, np.int8), least):
            got |= {tuple(code[a, :i].tolist()): int(t) for a, i, t in zip(at, k, times)}
        assert got == {p: c for p, c in want.items() if c >= least}


def test_scores_may_pass_64_bits(spark):
    rows = [(10 ** 17 + 3, 3 * 10 ** 17, 10 ** 17 + 9), (30, 31, 33), (10 ** 13, 10 ** 13, 10 ** 13)]
    found = spark.createDataFrame(rows, "a long, l long, r long").select(collocations.cut_score()).collect()
    assert [f[0] for f in found] == [2_000_000 * a // (left + right) for a, left, right in rows]


def test_long_texts_are_cut_between_pieces():
    text = words.utf8("one two. three" * 50 + "x" * 300 + "; end, " * 9)
    parts = list(collocations._cut(text, 64))
    assert b"".join(parts) == text and len(parts) > 10
    assert all(chr(p[-1]) in ".,;:!?\n" for p in parts[:-1])


ITEMS = [(1, "New York of the"), (1, "of the of the of the town"), (2, "word4 word9, WORD16 tail"), (3, ""), (4, None),
         (None, "two words à"), (5, "nowhere-found"), (6, "b a ½ x"), (7, " ".join(f"word{i} the" for i in range(400)))]


@pytest.mark.parametrize("item_bytes, postings", [(1 << 20, 1 << 21), (1500, 8)], ids=["large", "blocks"])
def test_best_documents_of_odd_rows(spark, docs, item_bytes, postings):
    items = spark.createDataFrame([(*i, "x", "y") for i in ITEMS], "item_id long, text string, item string, rank string")
    found = ranked_search.best_documents(docs, items, 4, item_bytes, postings)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    want = brute.best_documents([t[:2] for t in TEXTS], ITEMS, 4)

    def odd(r):
        return tuple((v is None, v or 0) for v in r)
    assert sorted((tuple(r) for r in found.collect()), key=odd) == sorted(want, key=odd)


def test_search_in_empty_tables(spark, docs):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert ranked_search.best_documents(docs.limit(0), items).collect() == []
    assert ranked_search.best_documents(docs, items.limit(0)).collect() == []
    assert ranked_search.best_documents(docs.where("text is null"), items).collect() == []


def test_search_stops_before_the_lists_end():
    texts = [words.utf8(t) for t in pq.read_table(f"{FOLDER}/documents.parquet")["text"].to_pylist()]
    items = pq.read_table(f"{FOLDER}/benchmark.parquet").to_pylist()
    block = ranked_search.items_of([(i["item_id"], i["text"]) for i in items])
    lengths, held, terms, counts = ranked_search._occurrences(texts, block.vocabulary)
    df = np.bincount(terms, minlength=len(block.vocabulary))
    weights = ranked_search.term_weights(int((lengths > 0).sum()), df)
    lists = ranked_search.Block(lengths, held, terms, counts, len(df), int((lengths > 0).sum()), int(lengths.sum()))
    read = stored = carried = 0
    for own, n in zip(block.terms, block.repeats):
        none = np.zeros(0, np.int64)
        _, scores, accesses = lists.search(own, weights[own] * n, 10, none)
        best = np.sort(scores)[::-1][:10]
        read += accesses
        stored += int(df[own][weights[own] > 0].sum())
        # where an earlier block had as good ones, the search stops sooner, with those that are still among the best
        _, again, fewer = lists.search(own, weights[own] * n, 10, best)
        assert (np.sort(again)[::-1] == best[:len(again)]).all()
        carried += fewer
    assert read < 0.6 * stored and carried <= read


def test_quality_of_held_out_documents(spark):
    labels = {r["doc_id"]: r["quality"] for r in brute.rows(FOLDER, "labels")}
    rows = QUERIES["op13_quality"](spark, FOLDER).collect()
    documents = brute.rows(FOLDER, "documents")
    assert sorted(r.doc_id for r in rows) == sorted(d["doc_id"] for d in documents)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)
    held = [r for r in rows if r.held_out and r.doc_id in labels]
    right = [r.predicted == labels[r.doc_id] for r in held]
    assert len(held) > 60 and np.mean(right) >= 0.96
    assert np.mean([r.predicted == 0 for r in held if labels[r.doc_id] == 0]) >= 0.9


def test_discriminant_is_that_of_the_plain_version(spark):
    documents = spark.read.parquet(f"{FOLDER}/documents.parquet")
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    found = {r.doc_id: r.score for r in quality.score(documents, labels).collect()}
    own = {d["doc_id"]: d["text"] for d in brute.rows(FOLDER, "documents")}
    known = [(r["doc_id"], r["quality"]) for r in brute.rows(FOLDER, "labels")
             if zlib.crc32(str(r["doc_id"]).encode()) % 4 != 2]
    x = quality.statistics([own[i] for i, _ in known]) / quality.STEPS
    new = quality.statistics(list(own.values())) / quality.STEPS
    want = brute.discriminant_scores(x, np.array([q for _, q in known]), new, quality.POOLED, quality.ROUND)
    assert np.allclose([found[i] for i in own], want, atol=1e-6)
    # labels that are held out have no say, and neither has the order of the rows
    other = labels.withColumn("quality", F.when(quality.held_out(F.col("doc_id")), 1 - F.col("quality"))
                              .otherwise(F.col("quality"))).repartition(5)
    assert found == {r.doc_id: r.score for r in quality.score(documents.repartition(7), other).collect()}


def test_quality_of_odd_rows(spark, docs):
    labels = spark.createDataFrame(
        [(1, 1, "x"), (5, 1, "x"), (5, 1, "y"), (5, 0, "y"), (7, 0, "z"), (8, 0, "z"), (9, None, "z"), (None, 1, "z"),
         (10, 7, "z"), (99, 0, "z"), (13, 0, "x"), (12, 1, "x")], "doc_id long, quality int, x string")
    found = quality.score(docs, labels).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in found) == sorted((t[0] is None, t[0] or 0) for t in TEXTS)
    assert all(0 <= r.score <= 1 and r.predicted in (0, 1) for r in found)
    by_text = {}
    texts = [(i, t) for i, t, _ in TEXTS]
    for i in (2, 3):
        by_text[i] = [r.score for r in found if r.doc_id == i]
    assert by_text[2] == by_text[3] and len(texts) == len(found)
    one = quality.score(docs, labels.where("quality = 1")).collect()
    assert all(r.score == 1 and r.predicted == 1 for r in one)
    assert {r.score for r in quality.score(docs, labels.limit(0)).collect()} == {0.5}
    assert quality.score(docs.limit(0), labels).collect() == []


def test_statistics_do_not_depend_on_neighbours():
    texts = [t for _, t, _ in TEXTS]
    together = quality.statistics(texts)
    assert (together == np.concatenate([quality.statistics([t]) for t in texts])).all()
    assert quality.statistics([]).shape == (0, len(quality.STATISTICS))
