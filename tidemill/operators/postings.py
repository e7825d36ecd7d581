"""Keyword search by an inverted index: a table from word to line, kept like any other serving table.

A posting says that a word occurs in the product name of a line. Postings lie in folders by a hash of the word, sorted by
day and word inside, so that a search opens the folders of its words and in these the row groups of its day. The lines
that have all words are those that are counted once for each; they are looked up in the sale table, where the name is
checked once more, as a line may have been stored again under another name since.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemill.functions import text

#: Folders of words; a folder with a frequent word is split into files by size.
BUCKETS = 32


def _bucket(token: Column) -> Column:
    return F.format_string("%02d", F.pmod(F.xxhash64(token), F.lit(BUCKETS)))


def postings(sales: DataFrame, tokenizer: text.Tokenizer = text.words) -> DataFrame:
    """(token, order_detail_id, dt, bucket): a row for each different word of a product name; no name, no rows."""
    return sales.select(
        F.explode(F.array_distinct(tokenizer(F.col("sku_name")))).alias("token"), "order_detail_id", "dt",
    ).withColumn("bucket", _bucket(F.col("token")))


def tokens_of(spark: SparkSession, keyword: str, tokenizer: text.Tokenizer = text.words) -> dict[str, str]:
    """The words of a keyword and their buckets."""
    words = F.explode(F.array_distinct(tokenizer(F.lit(keyword)))).alias("token")
    rows = spark.range(1).select(words).select("token", _bucket(F.col("token")).alias("bucket")).collect()
    return {r["token"]: r["bucket"] for r in rows}


def of_words(index: DataFrame, tokens: dict[str, str], day: str | None = None) -> DataFrame:
    """The postings of the words; the folders of other words are not listed."""
    rows = index.where(F.col("bucket").isin(sorted(set(tokens.values()))) & F.col("token").isin(list(tokens)))
    return rows if day is None else rows.where(F.col("dt") == day)


def lines_with(index: DataFrame, tokens: dict[str, str], day: str | None = None) -> DataFrame:
    """(order_detail_id, dt) of the lines that have every word."""
    # a word may have been stored more than once for a line; one flag for each word makes one shuffle do
    flags = [F.bool_or(F.col("token") == t) for t in tokens]
    every = reduce(Column.__and__, [F.col(f"has_{i}") for i in range(len(flags))])
    return (
        of_words(index, tokens, day).groupBy("order_detail_id", "dt")
        .agg(*[has.alias(f"has_{i}") for i, has in enumerate(flags)]).where(every)
        .select("order_detail_id", "dt"))


def search(
    sales: DataFrame, index: DataFrame, day: str | None, keyword: str, tokenizer: text.Tokenizer = text.words
) -> DataFrame:
    """Sales whose product name holds every word of the keyword, found in the index; none for a keyword without words."""
    if day is not None:
        sales = sales.where(F.col("dt") == day)
    tokens = tokens_of(sales.sparkSession, keyword, tokenizer)
    if not tokens:
        return sales.where(F.lit(False))
    found = lines_with(index, tokens, day)
    same = [sales[c].eqNullSafe(found[c]) for c in ("order_detail_id", "dt")]
    return sales.join(found, same, "left_semi").where(
        text.has_all_tokens(F.col("sku_name"), F.lit(keyword), tokenizer))
