"""Feed rows of the given tables to the jobs as topics, in time order and several runs."""

from __future__ import annotations

from collections.abc import Callable
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemill.schemas import TOPIC_COLUMNS
from tidemill.session import job_session, work_dir  # noqa: F401
from tidemill.streaming.tables import folder, listed


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{work_dir(spark)}/{name}-{uuid4().hex}"


def messages(rows: DataFrame, topic: str, timestamp: Column, offset: Column | None = None) -> DataFrame:
    """Records as JSON messages of a topic."""
    fields = [c for c in rows.columns if not dict(rows.dtypes)[c].startswith("timestamp")]
    return rows.select(
        F.lit(topic).alias("topic"),
        F.lit(None).cast("string").alias("key"),
        F.to_json(F.struct(*fields)).alias("value"),
        (F.unix_micros(timestamp) if offset is None else offset).alias("offset"),
        timestamp.alias("timestamp"),
    ).select(*TOPIC_COLUMNS.names)


def feed(
    topics: DataFrame, path: str, slices: int, run: Callable[[], None], times: DataFrame | None = None,
    last: Column | None = None,
) -> None:
    """Append the messages in ``slices`` steps of rising time, running the jobs after each.

    Every run but the first continues from the checkpoint of the one before. Messages without a time come first, those
    for which ``last`` holds in a step of their own after all others. The messages are made and written once, a folder
    for each slice; the files of a slice move to the topic when its turn comes. ``times`` are rows whose ``timestamp``
    divides the steps in place of that of the messages, where these are costly to make.
    """
    spark = topics.sparkSession
    edges: list = []
    if slices > 1:
        shares = [i / slices for i in range(1, slices)]
        if times is None:
            times = topics if last is None else topics.where(~F.coalesce(last, F.lit(False)))
        edges = times.agg(
            F.percentile_approx(F.unix_micros("timestamp"), shares, 1000)).first()[0] or []
    number = F.lit(0)
    for edge in edges:
        number = number + F.coalesce((F.unix_micros("timestamp") > edge).cast("int"), F.lit(0))
    steps = len(edges) + 1
    if last is not None:
        number = F.when(last, F.lit(steps)).otherwise(number)
        steps += 1
    staged = f"{path}-{uuid4().hex}"
    topics.withColumn("slice", number).write.partitionBy("slice").parquet(staged)
    topics.limit(0).write.mode("append").parquet(path)  # a slice may be empty, the topic is there all the same
    for n in range(steps):
        _move_files(spark, f"{staged}/slice={n}", path, f"{n}-{uuid4().hex}-")
        run()


def _move_files(spark: SparkSession, source: str, target: str, prefix: str) -> None:
    """The files get names of their own, as a task gives its files of every slice the same name."""
    for name in listed(spark, source):
        moved, files = folder(spark, f"{source}/{name}")
        to, _ = folder(spark, f"{target}/{prefix}{name}")
        if not name.startswith(("_", ".")) and not files.rename(moved, to):
            raise RuntimeError(f"{moved} could not be moved to {target}")
