"""Queries over whole tables against plain versions and DuckDB."""

import base64
import hashlib
import struct
from collections import defaultdict

import public_tokenizers
import pytest
import tiktoken

import brute
from oracle import compare, connect
from tidemill.llm import fingerprints, licenses
from tidemill.llm.queries import ORACLE, QUERIES

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def docs():
    return brute.rows(FOLDER, "documents")


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_duckdb(spark, name):
    assert compare(QUERIES[name](spark, FOLDER), connect(FOLDER), ORACLE[name]) > 0


def test_top_k_is_exact(spark):
    found = defaultdict(list)
    for r in sorted(QUERIES["op2_topk_search"](spark, FOLDER).collect(), key=lambda r: (r.query_id, r.rank)):
        found[r.query_id].append((r.vec_id, r.score))
    assert found == brute.top_k(brute.rows(FOLDER, "embeddings"))


def test_mix_comes_near_its_targets(spark, docs):
    sizes, sources, taken = defaultdict(int), {}, defaultdict(int)
    for d in docs:
        sources[d["doc_id"]] = d["source"]
        sizes[d["source"]] += len(brute.WORD.findall(d["text"] or ""))
    target = brute.capped_targets(sizes)
    rows = QUERIES["op3_source_mixing"](spark, FOLDER).collect()
    for r in rows:
        source = sources[r.doc_id]
        assert r.source_size == sizes[source] and r.target == pytest.approx(target[source])
        assert 0 <= r.taken <= 3 * r.size
        taken[source] += r.taken
    largest = max(r.size for r in rows)
    assert all(abs(taken[s] - target[s]) <= largest for s in sizes)
    assert sum(taken.values()) == pytest.approx(sum(sizes.values()), rel=0.02)
    again = QUERIES["op3_source_mixing"](spark, FOLDER).collect()
    assert {tuple(r) for r in rows} == {tuple(r) for r in again}


def test_repeats_are_those_of_the_plain_version(spark, docs):
    rows = QUERIES["op5_suffix_dedup"](spark, FOLDER).collect()
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in rows} == brute.removed(docs)


def test_ids_are_those_of_the_tokenizer(spark, docs):
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    known = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    found = {r.doc_id: r for r in QUERIES["op6_byte_bpe"](spark, FOLDER).collect()}
    for d in docs:
        ids, r = known.encode_ordinary(d["text"] or ""), found[d["doc_id"]]
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256((d["text"] or "").encode()).hexdigest()


def test_fingerprints_follow_the_next_document(spark, docs):
    found = {r.doc_id: r for r in QUERIES["op8_fingerprints"](spark, FOLDER).collect()}
    order = sorted(docs, key=lambda d: d["doc_id"])
    by_text = defaultdict(set)
    for d, after in zip(order, order[1:] + order[:1]):
        text, r = d["text"] or "", found[d["doc_id"]]
        new = fingerprints.edited(text, after["text"] or "")
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(new.encode()).hexdigest())
        assert r.fingerprint == fingerprints.hexed(fingerprints.sketch(text))
        assert r.edited_fingerprint == fingerprints.hexed(fingerprints.sketch(new))
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        by_text[text].add(r.fingerprint)
    assert all(len(f) == 1 for f in by_text.values())
    assert sum(r.near_edited > r.near_next for r in found.values()) > 0.95 * len(found)


def test_near_copies_are_those_of_the_plain_version(spark, docs):
    rows = QUERIES["op9_near_dedup"](spark, FOLDER).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == brute.near(docs, 4)
    assert all(r.kept == (r.doc_id == r.component_id) for r in rows)


def test_language_of_held_out_documents(spark, docs):
    lang = {d["doc_id"]: d["lang"] for d in docs}
    rows = QUERIES["op10_language_id"](spark, FOLDER).collect()
    held = [r for r in rows if r.held_out]
    assert len(rows) == len(docs) and len(held) > 100
    assert sum(r.lang_pred == lang[r.doc_id] for r in held) >= 0.97 * len(held)


def test_licenses_with_and_without_changes(docs, spark):
    phrases = {"Apache-2.0", "CC-BY-NC-4.0", "GPL-3.0", "MIT"}
    want = {(d["doc_id"], n) for d in docs for n in phrases if licenses.TEMPLATES[n] in (d["text"] or "")}
    rows = QUERIES["op1_license_scan"](spark, FOLDER).collect()
    assert {r.doc_id for r in rows} == {d["doc_id"] for d in docs}
    assert want <= {(r.doc_id, r.license) for r in rows}
    scanner = licenses.Scanner(licenses.TEMPLATES)
    twice = "the the. Released under the MIT License. x released, under the MIT license"
    assert scanner.scan(twice) == [("MIT", 1.0, 2, 6, 2)]
    near = "This work is hereby licensed under the GNU General Public License version 3"
    assert [f[0] for f in scanner.scan(near)] == ["GPL-3.0"]
    assert scanner.scan("under the general version of this work") == []
