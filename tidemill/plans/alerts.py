"""Coupon alerts: three users or more took coupons on one device without looking at an item."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemill.functions import scalar
from tidemill.operators import keyed, windows

MIN_USERS = 3


def coupon_alerts(
    events: DataFrame, size: int = 300, slide: int = 5, min_users: int = MIN_USERS
) -> DataFrame:
    """Windows that raise an alert, with their users, items and events."""
    return alerts_of(windows.panes(events, size, slide), size, slide, min_users)


def alerts_of(panes: DataFrame, size: int = 300, slide: int = 5, min_users: int = MIN_USERS) -> DataFrame:
    """The same from counted panes, such as a stream stores."""
    held = windows.windows_of(panes, size, slide, min_users, clicked=False)
    return held.withColumn("events", windows.event_list(F.col("event_counts"))).drop(
        "event_counts", "clicked")


def per_minute(alerts: DataFrame) -> DataFrame:
    """One alert per device and minute, the latest; ``id`` names device and minute."""
    named = alerts.withColumn("id", scalar.minute_id(F.col("mid"), F.col("window_end")))
    last = keyed.first_per_key(named, ["id"], [F.col("window_end").desc()])
    return last.select(
        "id", "mid", "uids", "item_ids", "events",
        F.unix_millis("window_end").alias("ts"),
        F.date_format("window_end", "yyyy-MM-dd").alias("dt"),
    )
