"""Words of any length in the tokenizer, and rows that share a hash in the mix."""

import base64
import random
import time

import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from tidemill.llm import byte_bpe, mixing


@pytest.fixture(scope="module")
def ranks():
    with open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


def test_long_words_are_those_of_the_tokenizer(ranks):
    known = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    pick = random.Random(2)
    words = ["a" * n for n in (101, 102, 1000)] + ["ab" * 300, "thethe" * 90, "é" * 400]
    words += ["".join(pick.choices("abcdefghijklmnopqrstuvwxyzäß", k=pick.randrange(90, 900))) for _ in range(60)]
    for word in words:
        assert byte_bpe.merged(word.encode(), ranks) == known.encode_ordinary(word)
    began = time.perf_counter()
    long = "".join(pick.choices("etaoinshrdlu", k=1 << 20))
    ids = byte_bpe.Encoder(ranks, public_tokenizers.PATTERN)(long)
    assert time.perf_counter() - began < 60
    assert byte_bpe.Encoder(ranks, public_tokenizers.PATTERN).decode(ids) == long.encode()
    assert len(ids) // 4 == len(known.encode_ordinary(long))


def test_remembered_words_are_bounded(ranks, monkeypatch):
    monkeypatch.setattr(byte_bpe, "REMEMBERED_BYTES", 1000)
    encoder = byte_bpe.Encoder(ranks, public_tokenizers.PATTERN)
    first = encoder("x" * 3000 + " and more")
    assert not encoder.known and encoder("x" * 3000 + " and more") == first


def test_rows_that_share_a_hash_get_their_own_copies(spark, monkeypatch):
    # all rows have one key
    real = F.xxhash64

    def one(*columns):
        return F.lit(7).cast("long") if columns[:1] == ("doc_id",) and len(columns) == 3 else real(*columns)
    rows = spark.createDataFrame([(i, f"s{i % 3}", "word " * (i % 5 + 1)) for i in range(60)],
                                 "doc_id long, source string, text string")
    monkeypatch.setattr(mixing.F, "xxhash64", one)
    found = mixing.copies(rows).collect()
    assert sorted(r.doc_id for r in found) == list(range(60))
    assert all(r.copies <= 3 for r in found)
    taken = {s: sum(r.copies * r.size for r in found if r.doc_id % 3 == s) for s in range(3)}
    target = {r.doc_id % 3: r.target for r in found}
    assert all(abs(taken[s] - target[s]) <= 5 for s in range(3))
