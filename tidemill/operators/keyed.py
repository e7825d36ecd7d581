"""One row per key, and lookups by key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

# Copies of a lookup table's row that a join spreads the facts of one key over.
SALTS = 4


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key in the given order.

    ``row_number() = 1`` lets Catalyst place a group limit on both sides of the shuffle, so every map
    task sends at most one row per key and a key that owns a third of the rows stays cheap.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).where("_rank = 1").drop("_rank")


#: Keys that are not alone, up to which their rows are told from the others by a lookup.
MOST_REPEATED = 500_000


def repeated(keys: DataFrame) -> DataFrame:
    """(_key): hashes of the keys that occur more than once, and of those that share the hash of another. Only hashes
    are shuffled."""
    hashes = keys.select(F.xxhash64(*keys.columns).alias("_key"))
    return hashes.groupBy("_key").agg(F.count("*").alias("n")).where("n > 1").select("_key")


def split(rows: DataFrame, keys: Sequence[str], hashes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows whose keys have none of the hashes, and the others."""
    hashed = rows.withColumn("_key", F.xxhash64(*keys))
    return tuple(hashed.join(hashes, "_key", how).drop("_key") for how in ("left_anti", "left_semi"))


def spread_join(
    facts: DataFrame, table: DataFrame, keys: Sequence[str], spread: Sequence[str], how: str = "left",
    salts: int = SALTS,
) -> DataFrame:
    """Join facts to a much smaller table that has one row per key.

    One key may own a third of the facts. AQE splits such a key only where both sides come straight from a
    shuffle, which a deduplicated table does not: it keeps the partitioning of its window. So the facts of
    a key are dealt over ``salts`` partitions by a hash of their ``spread`` columns, the same on a retry,
    and every table row is sent to each of them. A table small enough is broadcast all the same.
    """
    dealt = facts.withColumn("_salt", F.pmod(F.xxhash64(*spread), F.lit(salts)).cast("int"))
    copies = table.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return dealt.join(copies, [*keys, "_salt"], how).drop("_salt")


def drop_seen(
    rows: DataFrame, seen: DataFrame, keys: Sequence[str], spread: Sequence[str]
) -> DataFrame:
    """Rows whose key is not in the seen set."""
    return spread_join(rows, seen.select(*keys), keys, spread, "left_anti")


def keep_listed(table: DataFrame, wanted: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of a serving table for the keys at hand."""
    return table.join(wanted.select(*keys).distinct(), list(keys), "left_semi")
