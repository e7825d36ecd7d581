"""Keyword matching."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F

Tokenizer = Callable[[Column], Column]

# Fixed value: an ideograph or kana is a word of its own, other letters and digits run together.
WORD = r"[\p{IsHan}\p{IsHiragana}]|[\p{L}\p{N}&&[^\p{IsHan}\p{IsHiragana}]]+"


def words(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0))


def has_all_tokens(text: Column, keyword: Column, tokenizer: Tokenizer = words) -> Column:
    """Every token of the keyword occurs in the text; a keyword without tokens matches nothing.

    The keyword is normally a literal, so its tokens fold to a constant array. Another analyzer, such as
    one with a word list, is passed as ``tokenizer``.
    """
    wanted = tokenizer(keyword)
    return (F.size(wanted) > 0) & (F.size(F.array_except(wanted, tokenizer(text))) == 0)
