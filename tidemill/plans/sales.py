"""Sale details: orders with their lines and users."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemill.functions import scalar
from tidemill.operators import joins, keyed
from tidemill.schemas import SALE_DETAIL


def as_details(details: DataFrame) -> DataFrame:
    """Order lines with the column names the joins expect."""
    return details.withColumnRenamed("id", "order_detail_id")


PROFILE = ("birthday", "user_gender", "user_level")


def pair(
    orders: DataFrame, details: DataFrame, within: str = "1 hour", salts: int = joins.ORDER_SALTS,
    carry: tuple[str, ...] = (), carry_line: tuple[str, ...] = (),
) -> DataFrame:
    """Order and line pairs at most ``within`` apart, reduced to what a sale detail holds; ``carry`` and
    ``carry_line`` name columns of the orders and of the lines to keep."""
    order_columns = orders.select("id", "order_status", "create_time", "user_id", "order_ts", *carry)
    line_columns = as_details(details).select(
        "order_detail_id", "order_id", "sku_id", "sku_name", "order_price", "detail_ts", *carry_line)
    joined = joins.interval_join(order_columns, line_columns, within, salts)
    return joined.select(
        "order_detail_id",
        F.col("id").alias("order_id"),
        "order_status",
        "create_time",
        "user_id",
        "sku_id",
        F.coalesce(scalar.to_price(F.col("order_price")), F.lit(0.0)).alias("sku_price"),
        "sku_name",
        scalar.create_date(F.col("create_time")).alias("dt"),
        *carry,
        *carry_line,
    )


def latest_users(changes: DataFrame, *order: str) -> DataFrame:
    """The newest row of each user by the given columns, largest first."""
    newest = [F.col(c).desc() for c in order]
    return keyed.first_per_key(changes, ["id"], newest)


def enrich(sales: DataFrame, users: DataFrame, as_of: Column | str) -> DataFrame:
    """Add the user's age, gender and level, one user row per id; a sale without a user keeps age 0.

    ``as_of`` may be a column of the sales.
    """
    return aged(with_profile(sales, users, "order_detail_id"), as_of)


def with_profile(rows: DataFrame, users: DataFrame, spread: str) -> DataFrame:
    """The rows with the ``PROFILE`` of their user, one user row per id; ``spread`` deals the rows of a user."""
    profile = users.select(
        F.col("id").alias("user_id"), "birthday", F.col("gender").alias("user_gender"), "user_level")
    return keyed.spread_join(rows, profile, ["user_id"], [spread])


def aged(sales: DataFrame, as_of: Column | str) -> DataFrame:
    """Sales with their ``PROFILE`` as they are stored."""
    day = F.lit(as_of) if isinstance(as_of, str) else as_of
    age = F.coalesce(scalar.age_years(F.col("birthday"), day.cast("date")), F.lit(0))
    return sales.withColumn("user_age", age).select(*SALE_DETAIL.names)


def sale_detail(
    orders: DataFrame, details: DataFrame, users: DataFrame, as_of: Column | str,
    within: str = "1 hour",
) -> DataFrame:
    """As :func:`enrich` gives the pairs. The profile is looked up for the orders, of which there are far fewer than
    lines, and comes to the lines with their order."""
    placed = with_profile(orders.select("id", "order_status", "create_time", "user_id", "order_ts"), users, "id")
    return aged(pair(placed, details, within, carry=PROFILE), as_of)


def product_sales(orders: DataFrame, details: DataFrame, day: str | None = None) -> DataFrame:
    """Quantity by product over the lines of the day's orders, or of all orders."""
    if day is not None:
        orders = orders.where(scalar.create_date(F.col("create_time")) == day)
    wanted = orders.select(F.col("id").alias("order_id"))
    return (
        keyed.spread_join(details, wanted, ["order_id"], ["id"], "left_semi", joins.ORDER_SALTS)
        .groupBy(F.col("sku_name").alias("name"))
        .agg(F.sum(F.col("sku_num").try_cast("bigint")).alias("num"))
    )
