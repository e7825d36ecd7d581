"""Orders: masked phone, date split, first-order flag, amounts."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemill.functions import scalar
from tidemill.operators import keyed


def prepare(orders: DataFrame) -> DataFrame:
    """Mask the phone number and split the creation time."""
    return (
        orders.withColumn("consignee_tel", scalar.mask_phone(F.col("consignee_tel")))
        .withColumn("create_date", scalar.create_date(F.col("create_time")))
        .withColumn("create_hour", scalar.create_hour(F.col("create_time")))
    )


def with_user_state(orders: DataFrame, user_state: DataFrame) -> DataFrame:
    """Every order with whether its user has ordered before ("1") or not ("0"); one state row per user."""
    known = user_state.select("user_id", "if_ordered")
    return keyed.spread_join(orders, known, ["user_id"], ["id"]).withColumn(
        "if_ordered", F.coalesce("if_ordered", F.lit("0")))


def first_orders(orders: DataFrame) -> DataFrame:
    """The earliest order of each user, equal times by id: user_id, id, create_time."""
    return keyed.first_per_key(
        orders.select("user_id", "id", "create_time"), ["user_id"],
        [F.col("create_time"), F.col("id")])


def flag_first(orders: DataFrame, user_state: DataFrame | None = None) -> DataFrame:
    """Flag each user's first order "1" unless the state knows the user; all others "0".

    The first orders are found on three columns, combined before their shuffle, and joined back by order
    id: a user with a third of all orders never meets in one task.
    """
    first = first_orders(orders)
    if user_state is not None:
        ordered = user_state.where(F.col("if_ordered") == "1").select("user_id").distinct()
        first = first.join(ordered, "user_id", "left_anti")
    return mark(orders, first.select("id"))


def mark(orders: DataFrame, first_ids: DataFrame) -> DataFrame:
    """Set ``if_first_order`` from the ids of the first orders."""
    flags = first_ids.withColumn("if_first_order", F.lit("1"))
    return orders.join(flags, "id", "left").withColumn(
        "if_first_order", F.coalesce("if_first_order", F.lit("0")))


def new_user_state(flagged: DataFrame) -> DataFrame:
    """State rows of the users whose first order this is."""
    return flagged.where(F.col("if_first_order") == "1").select(
        "user_id", F.col("if_first_order").alias("if_ordered"))


def amount_total(orders: DataFrame, day: str) -> DataFrame:
    """The day's amount, 0.0 without orders."""
    total = F.coalesce(scalar.money(F.col("total_amount")), F.lit(0.0))
    return orders.where(F.col("create_date") == day).agg(total.alias("total_amount"))


def amount_hour(orders: DataFrame, day: str) -> DataFrame:
    return (
        orders.where(F.col("create_date") == day)
        .groupBy("create_hour").agg(scalar.money(F.col("total_amount")).alias("total_amount")))


def province_sales(orders: DataFrame, day: str | None = None) -> DataFrame:
    """Amount and number of orders by province, of one day or of all."""
    if day is not None:
        orders = orders.where(F.col("create_date") == day)
    return orders.groupBy("province_id").agg(
        scalar.money(F.col("total_amount")).alias("total_amount"),
        F.count("*").alias("order_count"))
