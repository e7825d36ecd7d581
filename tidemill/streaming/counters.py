"""Day counters of the KPI board, kept up with every batch instead of counted from history.

A counter is a value by metric and day. A batch adds its changes to the values that stood before it, which a replay finds
again. Changes go both ways: a device whose first day turns out to be an earlier one leaves the count of new devices
of one day for that of another, and an order that is stored again takes its former amount out of its former day.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import DecimalType, StructField, StructType

from tidemill.functions.scalar import cents
from tidemill.plans import dau as dau_plan
from tidemill.schemas import KPI_NAMES, strings
from tidemill.streaming.tables import KeyedTable

VALUE = "decimal(38,2)"
COUNTER = StructType([*strings("metric", "day"), StructField("value", DecimalType(38, 2))])
FIRST_DAY = StructType(strings("mid", "first_day"))


@dataclass(frozen=True)
class DeviceCounters:
    """Active devices and new devices by day, and the first day of each device."""

    counts: KeyedTable
    firsts: KeyedTable

    def create(self, spark: SparkSession) -> DeviceCounters:
        self.counts.create(spark)
        self.firsts.create(spark)
        return self


def counter_table(path: str) -> KeyedTable:
    """The newest value of a metric and day. A table belongs to one job."""
    return KeyedTable(path, COUNTER, ("metric", "day"))


def device_counters(path: str) -> DeviceCounters:
    firsts = KeyedTable(f"{path}/firsts", FIRST_DAY, ("mid",), ("first_day", "batch_id"))
    return DeviceCounters(counter_table(f"{path}/counts"), firsts)


def add(table: KeyedTable, changes: DataFrame, batch_id: int) -> None:
    """Add (metric, day, change) to the counters; several changes of one are summed."""
    spark = changes.sparkSession
    sums = (
        changes.groupBy("metric", "day").agg(F.sum("change").alias("change")).where("change <> 0 and day is not null"))
    stood = table.read(spark, before=batch_id)
    value = (F.coalesce("value", F.lit(0)) + F.col("change")).cast(VALUE).alias("value")
    table.upsert(sums.join(stood, ["metric", "day"], "left").select("metric", "day", value), batch_id)


def _change(metric: str, day: str, change: Column) -> list[Column]:
    return [F.lit(metric).alias("metric"), F.col(day).alias("day"), change.cast(VALUE).alias("change")]


def add_devices(counters: DeviceCounters, fresh: DataFrame, seen: DataFrame, batch_id: int) -> None:
    """Count a batch of first startups, one a device and day; ``seen`` holds the device days of earlier batches."""
    spark = fresh.sparkSession
    dated = fresh.where("log_date is not null").select(*dau_plan.DEVICE_DAY)
    active = dated.join(seen.select(*dau_plan.DEVICE_DAY), dau_plan.DEVICE_DAY, "left_anti").select(
        *_change("dau", "log_date", F.lit(1)))
    first = dated.groupBy("mid").agg(F.min("log_date").alias("first_day"))
    known = counters.firsts.read(spark, before=batch_id, wanted=first).withColumnRenamed("first_day", "known_day")
    earlier = first.join(known, "mid", "left").where("known_day is null or first_day < known_day").persist()
    try:
        added = earlier.select(*_change("new_mid", "first_day", F.lit(1)))
        taken = earlier.where("known_day is not null").select(*_change("new_mid", "known_day", F.lit(-1)))
        add(counters.counts, active.unionByName(added).unionByName(taken), batch_id)
        counters.firsts.upsert(earlier, batch_id)
    finally:
        earlier.unpersist()


def add_orders(counts: KeyedTable, orders: DataFrame, stored: DataFrame, batch_id: int) -> None:
    """Count a batch of orders, one row an id; ``stored`` holds what earlier batches stored of them."""
    amount = cents(F.col("total_amount"))
    added = orders.select(*_change("order_amount", "create_date", amount))
    taken = stored.select(*_change("order_amount", "create_date", -amount))
    add(counts, added.unionByName(taken), batch_id)


def board(counts: DataFrame, day: str) -> DataFrame:
    """The KPI board of a day from its counters alone; a metric without a counter is 0."""
    names = [F.struct(F.lit(k).alias("id"), F.lit(v).alias("name")) for k, v in KPI_NAMES.items()]
    metrics = counts.sparkSession.range(1).select(F.inline(F.array(*names)))
    of_day = counts.where(F.col("day") == day).select(F.col("metric").alias("id"), "value")
    return metrics.join(of_day, "id", "left").select(
        "id", "name", F.coalesce(F.col("value").cast("double"), F.lit(0.0)).alias("value"))
