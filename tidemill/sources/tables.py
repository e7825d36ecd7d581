"""Serving tables: day scans, key lookups and JDBC."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tidemill.operators.keyed import keep_listed


def read_days(
    spark: SparkSession, path: str, schema: StructType, day: str | None = None, partition: str = "dt"
) -> DataFrame:
    """A table partitioned by day; with ``day``, only that partition's files are listed and read."""
    if partition not in schema.names:
        schema = StructType(schema.fields + [StructField(partition, StringType())])
    table = spark.read.schema(schema).parquet(path)
    return table if day is None else table.where(F.col(partition) == day)


def write_days(rows: DataFrame, path: str, partition: str = "dt") -> None:
    """Write rows to their day's partition, replacing the days present.

    The rebalance hint packs small days together and splits a day too large for one task.
    """
    (rows.hint("rebalance", partition)
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(partition).parquet(path))


def read_jdbc(
    spark: SparkSession, url: str, table: str, column: str, lower: int, upper: int, partitions: int,
    **properties: str,
) -> DataFrame:
    """A database table read in parallel ranges of a numeric column."""
    return spark.read.jdbc(
        url, table, column=column, lowerBound=lower, upperBound=upper, numPartitions=partitions,
        properties=properties)


def lookup(table: DataFrame, wanted: DataFrame, key: str, *columns: str) -> DataFrame:
    """``select columns from table where key in (keys of wanted)``."""
    return keep_listed(table.select(key, *columns), wanted, [key])
