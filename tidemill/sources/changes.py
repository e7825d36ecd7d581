"""Row changes of the shop database.

A change entry is ``entry_type, schema_name, table_name, op, rows``; ``rows`` holds one after-image per
changed row, an array of (name, value) pairs whose values are all strings. ``position`` orders entries.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemill.functions.scalar import pairs_json
from tidemill.schemas import TOPIC_ORDER, TOPIC_ORDER_DETAIL, TOPIC_USER


def subscribe(entries: DataFrame, pattern: str) -> DataFrame:
    """Row-data entries of the tables whose ``schema.table`` name matches the pattern."""
    name = F.concat_ws(".", "schema_name", "table_name")
    return entries.where((F.col("entry_type") == "ROWDATA") & name.rlike(f"^(?:{pattern})$"))


def change_topic(table: Column, op: Column) -> Column:
    """The topic of a change, NULL for changes nobody reads."""
    insert = op == "INSERT"
    return (
        F.when(insert & (table == "order_info"), TOPIC_ORDER)
        .when(insert & (table == "order_detail"), TOPIC_ORDER_DETAIL)
        .when(op.isin("INSERT", "UPDATE") & (table == "user_info"), TOPIC_USER)
    )


def route_changes(entries: DataFrame, pattern: str) -> DataFrame:
    """One message per changed row: ``topic, key, value`` with the after-image as JSON.

    The key is the row's ``id``, so that the changes of a row stay in order within their partition; it is null
    for a row without one.
    """
    return (
        subscribe(entries, pattern)
        .withColumn("topic", change_topic(F.col("table_name"), F.col("op")))
        .where(F.col("topic").isNotNull())
        .withColumn("after", F.explode("rows"))
        .select(
            "topic",
            F.get(F.filter("after", lambda p: p["name"] == "id"), 0)["value"].alias("key"),
            pairs_json(F.col("after")).alias("value"),
            F.col("position").alias("offset"),
        )
    )
