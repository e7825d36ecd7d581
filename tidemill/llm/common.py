"""Helpers shared by the operators: reading, storing, batch sizes, hashing of numpy arrays."""

from __future__ import annotations

import uuid

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemill.session import work_dir

#: Rows of an Arrow batch that carries whole texts; a few long ones then fit a Python worker.
BATCH_ROWS = 512

WORD = r"[^\x20\x09-\x0D]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def small_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """Let Python workers take few texts at a time."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write to a table in the shared folder and read it back: later steps start from there."""
    path = f"{work_dir(df.sparkSession)}/llm-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def lower_ascii(text: Column) -> Column:
    return F.translate(text, _UPPER, _LOWER)


def text_bytes(docs: DataFrame, column: str = "text") -> int:
    """Total bytes of a text column; one narrow aggregate."""
    return docs.agg(F.sum(F.octet_length(column))).first()[0] or 0


def parts_for(total: int, each: int, least: int = 1) -> int:
    return max(least, -(-int(total) // each))


def mix64(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit words so that near values spread."""
    x = x ^ (x >> np.uint64(32))
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xA0761D6478BD642F)
    x ^= x >> np.uint64(32)
    return x
