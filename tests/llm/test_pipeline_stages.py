"""Stages of the pipeline against plain versions."""

import random
import struct

import public_tokenizers
import pytest
import tiktoken

import brute
import corpus_pipeline
from tidemill.llm import repeats
from tidemill.llm.byte_bpe import read_ranks

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet")


def plainly_cut(rows: list[dict], length: int = 50) -> dict[int, str]:
    """Texts without the bytes of passages that start in a document with a smaller id."""
    seen: dict[bytes, int] = {}
    found = {}
    for row in sorted(rows, key=lambda r: r["doc_id"]):
        raw = (row["text"] or "").encode()
        gone = set()
        for i in range(len(raw) - length + 1):
            if seen.setdefault(raw[i:i + length], row["doc_id"]) < row["doc_id"]:
                gone.update(range(i, i + length))
        found[row["doc_id"]] = bytes(c for i, c in enumerate(raw) if i not in gone).decode("utf-8", "ignore")
    return found


def test_cut_texts_are_those_of_the_plain_version(spark, docs):
    left = corpus_pipeline.cut_repeats(spark, docs, "")
    assert left.columns == docs.columns
    left = [r.asDict() for r in left.collect()]
    assert {r["doc_id"]: r["text"] for r in left} == plainly_cut([r.asDict() for r in docs.collect()])
    assert all(r["n_chars"] == len(r["text"]) for r in left)


@pytest.mark.parametrize("most", [2, 4096])
def test_passages_that_meet_in_some_of_their_windows(spark, monkeypatch, most):
    monkeypatch.setattr(repeats, "HOT", most)
    draw = random.Random(5)
    parts = ["".join(draw.choices("abcd ", k=draw.randint(20, 120))) for _ in range(40)]
    rows = [(i, "".join(draw.choices(parts, k=draw.randint(1, 6))) + "x" * draw.choice([0, 30, 200])) for i in range(120)]
    found = repeats.removed_bytes(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    plain = brute.removed([{"doc_id": i, "text": t} for i, t in rows])
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in found} == plain


def test_stage_of_tokens_gives_the_ids_of_the_tokenizer(spark, docs):
    ranks = read_ranks(public_tokenizers.path(corpus_pipeline.TOKENIZER))
    plain = tiktoken.Encoding("plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=dict(ranks), special_tokens={})
    texts = {r.doc_id: r.text or "" for r in docs.select("doc_id", "text").collect()}
    for row in corpus_pipeline.to_tokens(spark, docs, "").collect():
        ids = plain.encode_ordinary(texts[row.doc_id])
        assert row.intact and row.n_tokens == len(ids) and bytes(row.ids) == struct.pack(f"<{len(ids)}I", *ids)


def test_mix_stage_repeats_each_document_as_often_as_the_mix_takes_it(spark, docs):
    held = {r.doc_id: (r.text, r.lang, r.source) for r in docs.collect()}
    words, mixed, copies = {}, {}, {}
    for _, (text, _, source) in held.items():
        words[source] = words.get(source, 0) + len(brute.WORD.findall(text or ""))
    target = brute.capped_targets(words)
    rows = corpus_pipeline.mix_sources(spark, docs, "").collect()
    for r in rows:
        assert (r.text, r.lang, r.source) == held[r.doc_id]
        mixed[r.source] = mixed.get(r.source, 0) + len(brute.WORD.findall(r.text or ""))
        copies[r.doc_id] = copies.get(r.doc_id, 0) + 1
    assert max(copies.values()) <= 3
    longest = max(len(brute.WORD.findall(t or "")) for t, _, _ in held.values())
    assert all(abs(mixed.get(s, 0) - target[s]) <= longest for s in words)
