"""Order and detail joins, and the hour spine."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemill.operators.keyed import spread_join


# Orders are a quarter of the lines, so a join sends each order row to this many partitions at most.
ORDER_SALTS = 2


def salt_of(line_id: Column, salts: int) -> Column:
    """The salt that deals the lines of an order over ``salts`` partitions, the same on a retry."""
    return F.pmod(F.xxhash64(line_id), F.lit(salts)).cast("int")


def salted(orders: DataFrame, salts: int, name: str) -> DataFrame:
    """Each order once for every salt."""
    return orders.withColumn(name, F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))


def match_batch(orders: DataFrame, details: DataFrame, how: str = "inner") -> DataFrame:
    """Orders with the details of the same batch, ``inner`` or ``full_outer``.

    Each side keeps its columns; details must be given with distinct names (``order_detail_id``), except
    ``order_id``. Orders are unique by ``id``, and one order may own very many details. AQE can split such
    an order in an inner, left or anti join but never in a full outer one, so the latter is put together
    from a left join and the orders that no detail names.
    """
    lines = details.withColumnRenamed("order_id", "detail_order_id")
    keyed_orders = orders.withColumn("detail_order_id", F.col("id"))

    def joined(kind: str) -> DataFrame:
        return spread_join(
            lines, keyed_orders, ["detail_order_id"], ["order_detail_id"], kind, ORDER_SALTS)

    if how == "inner":
        return joined("inner")
    if how != "full_outer":
        raise ValueError(f"unsupported join: {how}")
    named = lines.select("detail_order_id").distinct()
    alone = orders.join(named, F.col("id") == F.col("detail_order_id"), "left_anti")
    return joined("left").unionByName(alone, allowMissingColumns=True)


def interval_join(
    orders: DataFrame,
    details: DataFrame,
    within: str = "1 hour",
    salts: int = ORDER_SALTS,
    order_time: str = "order_ts",
    detail_time: str = "detail_ts",
) -> DataFrame:
    """Each detail with its order when their times lie no further apart than ``within``.

    Works on batches and, with watermarks on both time columns, on streams. ``salts`` spreads the details
    of an order over that many partitions, each with its own copy of the order row. In a batch the salt
    also makes both sides shuffle, so that AQE can split a very large order further; lines that are dealt by
    order and salt already, as :func:`tidemill.sources.views.order_detail` deals them, stay where they are.
    """
    left, right = orders, details.withColumnRenamed("order_id", "detail_order_id")
    gap = F.expr(f"INTERVAL {within}")
    on = (
        (F.col("id") == F.col("detail_order_id"))
        & (F.col(detail_time) >= F.col(order_time) - gap)
        & (F.col(detail_time) <= F.col(order_time) + gap)
    )
    if salts > 1:
        left = salted(left, salts, "_order_salt")
        right = right.withColumn("_detail_salt", salt_of(F.col("order_detail_id"), salts))
        on = on & (F.col("_order_salt") == F.col("_detail_salt"))
    joined = right.join(left, on, "inner")
    return joined.drop("detail_order_id", "_order_salt", "_detail_salt")


def hour_spine(spark: SparkSession) -> DataFrame:
    """The 24 hours ``00`` to ``23``."""
    return spark.range(0, 24, 1, 1).select(F.lpad(F.col("id").cast("string"), 2, "0").alias("hour"))


def two_days(
    rows: DataFrame, day: str, hour: str, today: Column, yesterday: Column, value: Column | None = None
) -> DataFrame:
    """The hours of two days that have rows, over one scan: counts, or sums of ``value``; null where a day has no row."""
    def series(wanted: Column) -> Column:
        hit = F.col(day) == wanted
        some = F.count_if(hit)
        if value is None:
            return F.when(some > 0, some)
        total = F.sum(F.when(hit, value.cast("decimal(18,2)"))).cast("double")
        return F.when(some > 0, F.coalesce(total, F.lit(0.0)))

    return (
        rows.where((F.col(day) == today) | (F.col(day) == yesterday))
        .groupBy(F.col(hour).alias("hour"))
        .agg(series(yesterday).alias("yesterday"), series(today).alias("today"))
    )


def two_day_hours(
    rows: DataFrame, day: str, hour: str, today: Column, yesterday: Column, value: Column | None = None
) -> DataFrame:
    """Hour curves of two days side by side; missing hours are 0. At most 24 rows reach the spine join."""
    per_hour = two_days(rows, day, hour, today, yesterday, value)
    zero = F.lit(0) if value is None else F.lit(0.0)
    return (
        hour_spine(rows.sparkSession)
        .join(per_hour, "hour", "left")
        .select("hour", F.coalesce("yesterday", zero).alias("yesterday"),
                F.coalesce("today", zero).alias("today"))
    )
