"""Edges of the scalar and text functions."""

import pytest
from pyspark.sql import functions as F

from tidemill.functions import scalar, text


def one(spark, column, **values):
    """The value of an expression over one row; a value is given as (type, text)."""
    row = spark.range(1).select(*[
        F.lit(v).cast(t).alias(n) for n, (t, v) in values.items()] or ["id"])
    return row.select(column.alias("x")).first()["x"]


@pytest.mark.parametrize("tel, masked", [
    ("13812345678", "138****5678"), ("12", "12****"), ("12345", "123****"), ("1234567", "123****"),
    ("12345678", "123****8"), ("", "****"), (None, None)])
def test_mask_phone(spark, tel, masked):
    assert one(spark, scalar.mask_phone(F.col("t")), t=("string", tel)) == masked


@pytest.mark.parametrize("ts, day, hour", [
    (1579046399999, "2020-01-14", "23"), (1579046400000, "2020-01-15", "00"), (0, "1970-01-01", "00")])
def test_log_date_and_hour(spark, ts, day, hour):
    assert one(spark, scalar.log_date(F.col("t")), t=("bigint", ts)) == day
    assert one(spark, scalar.log_hour(F.col("t")), t=("bigint", ts)) == hour


def test_create_time_split(spark):
    at = ("string", "2020-03-02 07:08:09")
    assert one(spark, scalar.create_date(F.col("t")), t=at) == "2020-03-02"
    assert one(spark, scalar.create_hour(F.col("t")), t=at) == "07"
    assert one(spark, scalar.create_hour(F.col("t")), t=("string", "2020-03-02")) == ""


@pytest.mark.parametrize("birthday, age", [
    ("2000-08-01", 1), ("2000-08-02", 0), ("1961-08-01", 40), ("2001-08-01", 0), ("2005-01-01", -3),
    ("no date", None), (None, None)])
def test_age_is_days_over_365(spark, birthday, age):
    as_of = F.lit("2001-08-01").cast("date")
    assert one(spark, scalar.age_years(F.col("b"), as_of), b=("string", birthday)) == age


@pytest.mark.parametrize("part, total, share", [
    (2, 16, 12.5), (0, 0, 0.0), (1, 3, 33.3), (2, 3, 66.7), (1, 2000, 0.1), (1, 2001, 0.0), (5, 5, 100.0)])
def test_percent(spark, part, total, share):
    got = one(spark, scalar.percent(F.col("p"), F.col("t")), p=("bigint", part), t=("bigint", total))
    assert got == share


@pytest.mark.parametrize("price, value", [("12.5", 12.5), ("x", None), (None, None), ("7", 7.0)])
def test_to_price(spark, price, value):
    assert one(spark, scalar.to_price(F.col("p")), p=("string", price)) == value


def test_dates(spark):
    assert one(spark, scalar.yesterday(F.col("d")), d=("string", "2020-03-01")) == "2020-02-29"
    assert one(spark, scalar.compact_date(F.col("d")), d=("string", "2020-03-01")) == "20200301"


@pytest.mark.parametrize("at, minute", [
    ("1970-01-01 00:01:59", 1), ("1970-01-01 00:02:00", 2), ("1969-12-31 23:59:59", -1)])
def test_minute_id(spark, at, minute):
    got = one(spark, scalar.minute_id(F.lit("m"), F.col("t")), t=("timestamp", at))
    assert got == f"m_{minute}"


def test_money_is_exact(spark):
    amounts = spark.range(1000).select(F.lit(0.1).alias("x"))
    assert amounts.agg(scalar.money(F.col("x"))).first()[0] == 100.0


def test_pairs_json_leaves_nulls_out(spark):
    pairs = F.array(
        F.struct(F.lit("id").alias("name"), F.lit("7").alias("value")),
        F.struct(F.lit("n").alias("name"), F.lit(None).cast("string").alias("value")))
    assert one(spark, scalar.pairs_json(pairs)) == '{"id":"7"}'


@pytest.mark.parametrize("name, keyword, hit", [
    ("small ring", "ring small", True), ("Small-Ring!", "RING", True), ("small ring", "ring big", False),
    ("small ring", "", False), ("small ring", " - ", False), ("rings", "ring", False),
    ("小米手机", "手机", True), ("小米手机 10", "米 10", True), ("小米", "手机", False)])
def test_keyword_match(spark, name, keyword, hit):
    got = one(spark, text.has_all_tokens(F.col("n"), F.lit(keyword)), n=("string", name))
    assert got is hit


def test_keyword_match_with_another_tokenizer(spark):
    def bars(c):
        return F.split(c, r"\|")
    match = text.has_all_tokens(F.col("n"), F.lit("a b"), bars)
    assert one(spark, match, n=("string", "x|a b")) is True
    assert one(spark, match, n=("string", "x|a|b")) is False
