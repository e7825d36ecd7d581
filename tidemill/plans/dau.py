"""Daily active devices."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemill.functions import scalar
from tidemill.operators import keyed

DEVICE_DAY = ["mid", "log_date"]


def with_day(startups: DataFrame) -> DataFrame:
    """Add the log day and hour."""
    return startups.withColumn("log_date", scalar.log_date(F.col("ts"))).withColumn(
        "log_hour", scalar.log_hour(F.col("ts")))


def first_startup(startups: DataFrame) -> DataFrame:
    """The earliest startup of each device and day; equal times go by the other fields."""
    ties = [c for c in startups.columns if c not in (*DEVICE_DAY, "ts")]
    return keyed.first_per_key(startups, DEVICE_DAY, [F.col("ts"), *map(F.col, ties)])


def drop_seen(startups: DataFrame, seen: DataFrame) -> DataFrame:
    """Startups of devices not seen yet on that day."""
    return keyed.drop_seen(startups, seen, DEVICE_DAY, ["ts", "uid"])


def dau_total(dau: DataFrame, day: str) -> DataFrame:
    return dau.where(F.col("log_date") == day).agg(F.count("*").alias("total"))


def dau_hour(dau: DataFrame, day: str) -> DataFrame:
    return (
        dau.where(F.col("log_date") == day)
        .groupBy("log_hour").agg(F.count("*").alias("ct")))


def new_devices(dau: DataFrame, day: str | None = None) -> DataFrame:
    """Devices by their first day ever; with ``day``, that day's number alone.

    Only the device and the day are read, combined per map task before the shuffle.
    """
    if day is None:
        first = dau.groupBy("mid").agg(F.min("log_date").alias("log_date"))
        return first.groupBy("log_date").agg(F.count("*").alias("new_devices"))
    first = (
        dau.where(F.col("log_date") <= day).groupBy("mid").agg(F.min("log_date").alias("log_date")))
    return first.where(F.col("log_date") == day).agg(F.count("*").alias("new_devices"))
