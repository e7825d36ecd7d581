"""A corpus from documents to tokens: language, near copies, repeated passages, mix, ids.

Each stage takes (spark, docs, folder) and returns a table; all but the last return the columns of documents.
``run`` writes every stage as Parquet in the shared folder and reads it back for the next one, so that a lost
executor costs at most one stage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemill.llm import byte_bpe, language_id, mixing, near_dedup, repeats
from tidemill.llm.common import read, stored

#: A text of which the best language is less likely than this is rejected, like one without letters.
LEAST_SCORE = 0.5
TOKENIZER = "byte_bpe_multi_50k.tiktoken"


def keep_known_languages(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents whose language is told; the others go."""
    model = language_id.learn(docs.where(~language_id.held_out(F.col("doc_id"))))
    numbered = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    text = numbered[f"c{docs.columns.index('text')}"]
    judged = language_id.predict(numbered.withColumn("text", text), model, numbered.columns)
    kept = judged.where((F.col("lang_pred") != "und") & (F.col("score") >= LEAST_SCORE))
    return kept.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(docs.columns)])


def drop_near_copies(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One row of each group of near copies: that with the smallest id, one without id only where no other is left.

    Of rows with one id, and of rows without id, the hash of the text decides; equal rows are one. Texts without
    words stay.
    """
    return near_dedup.one_each(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Texts without the passages of 50 bytes or more that an earlier document has."""
    return repeats.cut(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Every document as often as the mix draws it."""
    return mixing.mix(docs)


def to_tokens(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """doc_id, lang, source, n_tokens, ids (little-endian 32-bit), intact: whether the ids decode to the text."""
    ranks = byte_bpe.read_ranks(public_tokenizers.path(TOKENIZER))
    bytes_of = F.coalesce(F.encode("text", "UTF-8"), F.lit(b""))
    rows = docs.select("doc_id", "lang", "source", F.sha2(bytes_of, 256).alias("whole"), "text")
    coded = byte_bpe.round_trip(rows, ranks, public_tokenizers.PATTERN, ["doc_id", "lang", "source", "whole"])
    return coded.select("doc_id", "lang", "source", byte_bpe.n_tokens().alias("n_tokens"), "ids",
                        (F.sha2("decoded", 256) == F.col("whole")).alias("intact"))


STAGES = [
    ("language ID", keep_known_languages),
    ("MinHash near-dedup", drop_near_copies),
    ("suffix-array dedup", cut_repeats),
    ("mixing sources to target weights", mix_sources),
    ("byte-level BPE", to_tokens),
]

#: Random rounding and merges by rank are beyond SQL; the tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        docs = stored(stage(spark, docs, sf_dir), f"stage{number}")
    return docs
