"""Nulls, empty and long texts, repeated rows, empty tables and clashing column names."""

import os
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import brute
import corpus_pipeline
from tidemill.llm import (
    byte_bpe, chat_format, fingerprints, language_id, licenses, mixing, near_dedup, repeats, topk_search, url_filter,
)

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, node int, value string, bucket string, "
          "occurrence string, c0 string, ids string, copies string, own string, block string, _id string, segment string")
LONG = " ".join(f"word{i * i} und" for i in range(30_000))
PASSAGE = "a passage of more than fifty bytes that several documents share in full, é"
TEXTS = [
    (1, LONG, "en", "a"), (2, None, "en", "a"), (3, "", None, None), (4, "?!? 123 ...", "de", "b"),
    (5, PASSAGE + " one", "en", "a"), (6, "two " + PASSAGE, "en", None), (6, "two " + PASSAGE, "en", None),
    (7, "two words", "fr", "b"), (8, "TWO words", "fr", "b"), (None, PASSAGE, None, "a"), (None, None, None, None),
    (9, LONG + " tail", "en", "a"), (10, "x", "de", "c"), (11, "ÀÉ ½ \U0001F600 'll z" + "\n" * 40, "fr", "c"),
    (12, "a" * 500, "en", "b"), (13, "b " * 300, "en", "b"), (4, "another text of the same number", "de", "b"),
]


@pytest.fixture(scope="module")
def docs(spark):
    extra = (0, "v", "b", "o", "c", "i", "n", "w", "k", "_", "s")
    rows = [(*t[:4], len(t[1] or ""), *extra) for t in TEXTS]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


RANKS = {bytes([i]): i for i in range(256)} | {b"ab": 256, b"aa": 257, b"aab": 258}
PATTERN = r" ?\p{L}+|\s+|[^\s\p{L}]+"


@pytest.mark.parametrize("apply", [
    licenses.scan, mixing.copies, repeats.removed_bytes, fingerprints.fingerprints, near_dedup.near_duplicates,
    language_id.identify, lambda d: byte_bpe.round_trip(d, RANKS, PATTERN, ["doc_id"]),
], ids=["licenses", "mixing", "repeats", "fingerprints", "near", "language", "bpe"])
def test_every_row_once_and_empty_tables(docs, none, apply):
    found = apply(docs).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in found) == sorted((t[0] is None, t[0] or 0) for t in TEXTS)
    assert apply(none).collect() == []


def test_license_places_are_the_best_of_all_starts():
    names = ["Apache-2.0-header", "GPL-3.0-or-later", "MIT-permission", "MIT"]
    templates = {n: licenses.TEMPLATES[n] for n in names}
    scanner, pick = licenses.Scanner(templates), random.Random(5)
    prose = "This is the manual of the tool, and it is free to read; you may copy any part of it under the usual terms.".split()
    for name, text in templates.items():
        for cut in range(len(prose)):
            verbatim = " ".join(prose[:cut]) + "\n" + text + " " + " ".join(prose[cut:])
            found = {f[0]: f[1:] for f in scanner.scan(verbatim)}[name]
            n = len(licenses.words(text))
            start = len(licenses.words(" ".join(prose[:cut])))
            assert found == (1.0, start, start + n - 1, 1)
    for _ in range(60):
        text = []
        for _ in range(pick.randrange(1, 4)):
            text += pick.choices(prose, k=pick.randrange(30))
            for word in licenses.words(templates[pick.choice(names)]):
                text += [w for w in (word, "other") if pick.random() < (0.95 if w == word else 0.15)]
        own = licenses.words(" ".join(text))
        want = []
        for name in names:
            plain = brute.places(own, licenses.words(templates[name]), licenses.align)
            if plain:
                want.append((name, *max(plain, key=lambda p: (p[0], -p[1])), len(plain)))
        assert scanner.scan(" ".join(text)) == want


def test_licenses_are_judged_by_their_whole_notices():
    scanner = licenses.Scanner(licenses.TEMPLATES)
    for name, text in licenses.TEMPLATES.items():
        found = {f[0]: f[1] for f in scanner.scan(f"Some words.\n{text}\nOther words.")}
        assert found[name] == max(found.values()) == 1.0
    families = ["AGPL", "Apache", "BSD-2", "BSD-3", "CC-BY-4", "CC-BY-SA", "CC0", "GPL-2", "GPL-3", "ISC", "LGPL-2.1", "LGPL-3", "MIT",
                "MPL", "Unlicense"]
    assert all(any(name.startswith(f) for name in licenses.TEMPLATES) for f in families)
    first_clause = licenses.TEMPLATES["MIT-permission"].split(", including")[0]
    assert scanner.scan(first_clause) == []
    for name, path in [("BSD-3-Clause", "BSD"), ("MPL-2.0", "MPL-2.0"), ("Apache-2.0-header", "Apache-2.0"), (
            "GPL-3.0-or-later", "GPL-3"), ("LGPL-2.1-or-later", "LGPL-2.1")]:
        path = f"/usr/share/common-licenses/{path}"
        if os.path.exists(path):
            assert {f[0]: f[1] for f in scanner.scan(open(path).read())}[name] > 0.9


def test_repeats_of_bytes(docs):
    rows = {(r.doc_id, r.n_bytes): r for r in repeats.removed_bytes(docs).collect()}
    size = len(PASSAGE.encode())
    # rows without id come first, so theirs is the original
    assert rows[None, size].n_removed == 0
    assert rows[5, size + 4].n_removed == size and rows[6, size + 4].n_removed == size
    assert rows[12, 500].n_removed == 0 and rows[9, len(LONG) + 5].n_removed == len(LONG)
    kept = {r.doc_id: r.text for r in repeats.cut(docs).collect() if r.doc_id in (5, 6, 9)}
    assert kept == {5: " one", 6: "two ", 9: " tail"}
    assert repeats.cut(docs).columns == docs.columns


def test_a_phrase_with_many_neighbours_is_dealt_over_segments(spark, monkeypatch):
    phrase = "Released under the usual terms of 2001."
    # other neighbours around one phrase in each document, every fifth as in the document 40 before
    texts = [(i, f"{i if i % 5 else i % 40:040d} {phrase} {'x' if i % 5 else 'y'}{i if i % 5 else i % 40:040d}") for i in range(400)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    plain = brute.removed([{"doc_id": a, "text": b} for a, b in texts])
    monkeypatch.setattr(repeats, "HOT", 64)
    monkeypatch.setattr(repeats, "BUCKET_BYTES", 1 << 14)
    monkeypatch.setattr(repeats, "SEGMENT_BYTES", 1 << 12)
    rows = repeats.removed_bytes(docs).collect()
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in rows} == plain
    # the windows of all documents, sent as one bucket: no segment has a large part of them
    ids, raw = np.array([i for i, _ in texts]), [t.encode() for _, t in texts]
    table = pa.table({"own_id": ids, "own_text": pa.array(raw, pa.binary()), "bucket": np.zeros(len(ids), dtype=np.int64)})
    asked = repeats._ask(16)(table)
    share = {}
    for most in (1 << 40, 64):
        answers = pa.concat_tables([repeats._answer(most)(asked.slice(i, 1)) for i in range(asked.num_rows)])
        sent = [len(b) for b in repeats._send(16)(table, answers)["bytes"].to_pylist()]
        share[most] = max(sent) / sum(sent)
    assert share[64] < 0.2 < share[1 << 40]


def test_near_copies(docs):
    rows = near_dedup.near_duplicates(docs, words=4).collect()
    groups = {(r.doc_id, r.n_shingles): r.component_id for r in rows}
    assert groups[8, 1] == 7 and groups[7, 1] == 7
    assert {c for (d, _), c in groups.items() if d == 9} == {1}
    assert all(r.kept for r in rows if r.n_shingles == 0)
    # a row without id joins the copies that have one
    assert {r.component_id for r in rows if r.doc_id is None} == {5, None}


def test_a_large_group_of_near_copies_is_one_component(spark):
    base = [f"w{i}" for i in range(200)]
    texts = [(i, " ".join(base[:i % 40] + [f"own{i}"] + base[i % 40:])) for i in range(300)]
    texts += [(1000 + i, " ".join(f"u{i}x{j % 190}" for j in range(200))) for i in range(50)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    rows = near_dedup.near_duplicates(docs, words=4).collect()
    plain = brute.near([{"doc_id": a, "text": b} for a, b in texts], 4)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == plain


def test_texts_that_hold_others_are_their_near_copies(spark):
    texts = []
    # at exactly 80 %, of sets whose smallest values pass 2 ** 63
    for n, (held, whole) in enumerate([(36, 45), (44, 55), (44, 55), (56, 70), (56, 70), (60, 75), (70, 87)] * 150):
        own = [f"p{n}w{i}" for i in range(whole + 3)]
        texts += [(2 * n, " ".join(own[:held + 3])), (2 * n + 1, " ".join(own))]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    rows = near_dedup.near_duplicates(docs, words=4).collect()
    plain = brute.near([{"doc_id": a, "text": b} for a, b in texts], 4)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == plain


def test_mixing_takes_whole_copies(docs):
    rows = mixing.copies(docs).collect()
    assert all(r.copies == 0 for r in rows if r.size == 0)
    assert all(r.copies <= 3 for r in rows)
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns
    assert mixed.count() == sum(r.copies for r in rows)


def test_rounding_in_a_tree_keeps_the_words_of_a_source(spark, monkeypatch):
    monkeypatch.setattr(mixing, "CHUNK", 8)
    monkeypatch.setattr(mixing, "FAN", 3)
    rows = [(i, "s1" if i % 3 else "s2", "w " * (1 + i % 17)) for i in range(600)]
    drawn = mixing.copies(spark.createDataFrame(rows, "doc_id long, source string, text string")).collect()
    assert len(drawn) == 600
    for size in {r.source_size for r in drawn}:
        own = [r for r in drawn if r.source_size == size]
        assert abs(sum(r.copies * r.size for r in own) - own[0].target) <= 17


def test_fingerprint_of_rows_in_order(docs):
    rows = fingerprints.fingerprints(docs).collect()
    assert {r.fingerprint for r in rows if r.n_chars == 0} == {fingerprints.hexed(fingerprints.sketch(""))}
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in rows)
    a, b = fingerprints.sketch(LONG), fingerprints.sketch("shift " + LONG)
    assert fingerprints.likeness(a, b) > 0.9


def test_fingerprints_of_long_texts_that_share_nothing():
    pick = np.random.default_rng(3)
    a, b = (bytes(pick.integers(97, 123, 6_000_000, dtype=np.uint8)).decode() for _ in range(2))
    assert fingerprints.likeness(fingerprints.sketch(a), fingerprints.sketch(b)) == 0


def test_languages(docs):
    rows = {(r.doc_id, r.lang_pred) for r in language_id.identify(docs).collect()}
    assert {(2, "und"), (3, "und"), (4, "und"), (None, "und")} <= rows


def test_tokens_of_odd_texts(docs):
    rows = byte_bpe.round_trip(docs, RANKS, PATTERN, ["doc_id", "text"]).collect()
    assert all(bytes(r.decoded).decode() == (r.text or "") for r in rows)
    assert byte_bpe.merged(b"aaab", RANKS) == [257, 256]
    ids = byte_bpe.encode(docs, RANKS, PATTERN, ["doc_id", "text"])
    back = byte_bpe.decode(ids, RANKS, PATTERN, ["doc_id", "text"]).collect()
    assert all(bytes(r.decoded).decode() == (r.text or "") for r in back)


def test_search_with_odd_vectors(spark):
    bad = [(1, None), (2, [1.0, None]), (3, [1.0, float("nan")]), (4, [float("inf"), 0.0]), (None, [1.0, 1.0])]
    good = [(50, [1.0, 0.5]), (100, [1.0, 0.5]), (6, [0.5, 0.25]), (7, [0.5, 0.25]), (7, [0.5, 0.25]), (8, [1.0])]
    table = spark.createDataFrame(bad + good, "vec_id long, embedding array<float>")
    rows = topk_search.top_k(table, F.col("id") % 50 == 0, 5).collect()
    assert sorted((r.query_id, r["rank"], r.vec_id) for r in rows) == [
        (50, 1, 100), (50, 2, 6), (50, 3, 7), (100, 1, 50), (100, 2, 6), (100, 3, 7)]
    assert topk_search.top_k(table.limit(0), F.col("id") % 50 == 0).collect() == []


def test_chats(spark):
    schema = "conv_id long, turn long, role string, text string, segment string"
    rows = [(1, 0, "user", "a"), (1, 1, "assistant", "b"), (2, 0, "user", "a"), (3, 0, "user", "a"), (3, 1, "assistant", "b"),
            (4, 0, None, None), (4, 0, None, None), (5, 0, None, None), (5, 1, "user", "c"), (None, 0, "user", "z"), (6, None, "user", "q")]
    table = spark.createDataFrame([(*r, "s") for r in rows], schema)
    found = {(r.conv_id, r.n_turns): r.text for r in chat_format.format_chats(table).collect()}
    assert set(found) == {(1, 2), (3, 2), (5, 2), (None, 1), (6, 1)}
    assert found[5, 2] == "<|im_start|>unknown\n<|im_end|>\n<|im_start|>user\nc<|im_end|>\n"
    long = spark.createDataFrame([(1, i, "user", f"t{i}") for i in range(2500)] + [
        (2, i, "user", f"t{i}") for i in range(2000)], "conv_id long, turn long, role string, text string")
    assert sorted((r.conv_id, r.part, r.n_turns) for r in chat_format.format_chats(long).collect()) == [
        (1, 0, 1024), (1, 1, 1024), (1, 2, 452)]
    assert chat_format.format_chats(table.limit(0)).collect() == []


def test_urls(spark):
    rows = [(1, None), (2, "no scheme"), (3, "http://www.X.org/a"), (4, "http://Y.net/p/?utm_source=q#f"), (5, "https://y.net:443/p"),
            (6, "http://y.net/p?z=1"), (7, "http://y.net"), (7, "http://y.net"), (8, ""), (9, "http://example.org/en/12")]
    pages = spark.createDataFrame(rows, "page_id long, url string")
    listed = spark.createDataFrame([("y.net/p",), ("y.net/p",), (None,)], "canonical string")
    rules = [url_filter.Rule("allow", "org", "/"), url_filter.Rule("block", "example.org", "/en/1")]
    found = sorted((r.page_id, r.host, r.path, r.rule, r.verdict) for r in url_filter.judge(pages, listed, rules).collect())
    assert found == [
        (1, "", "", None, "allow"), (2, "", "", None, "allow"), (3, "www.x.org", "/a", "org/", "allow"),
        (4, "y.net", "/p/", None, "block"), (5, "y.net:443", "/p", None, "block"), (6, "y.net", "/p", None, "allow"),
        (7, "y.net", "", None, "allow"), (7, "y.net", "", None, "allow"), (8, "", "", None, "allow"),
        (9, "example.org", "/en/1" + "2", "example.org/en/1", "block")]
    assert url_filter.judge(pages.limit(0), listed.limit(0), rules).collect() == []


def test_pipeline_over_odd_rows(spark, docs, none):
    rows = docs
    for name, stage in corpus_pipeline.STAGES:
        rows = stage(spark, rows, "")
        if name != corpus_pipeline.STAGES[-1][0]:
            assert rows.columns == docs.columns
    assert all(r.intact for r in rows.collect())
    for _, stage in corpus_pipeline.STAGES:
        none = stage(spark, none, "")
    assert none.collect() == []
