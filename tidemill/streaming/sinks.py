"""Writers for ``foreachBatch``; each overwrites its own batch, so replays change nothing."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Observation, functions as F

Writer = Callable[[DataFrame, int], None]


def fan_out(batch: DataFrame, batch_id: int, writers: Sequence[Writer]) -> None:
    """Several sinks for one computation; an empty batch writes nothing."""
    batch = batch.persist()
    try:
        if not batch.isEmpty():
            for write in writers:
                write(batch, batch_id)
    finally:
        batch.unpersist()


#: A batch of no more rows is gathered before it is written to few folders; a larger one is written where it lies.
SMALL = 10_000


def _small(rows: DataFrame) -> bool:
    return rows.select(F.lit(1)).offset(SMALL).isEmpty()


def _replace_batch(rows: DataFrame, path: str, source: str, *partitions: str, gather: bool = True) -> None:
    rows = rows.hint("rebalance", *partitions[:-1]) if gather else rows
    (rows.write.format(source).mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy(*partitions).save(path))


def archive(path: str) -> Writer:
    """Every stamped line to the text files of its day."""
    def write(batch: DataFrame, batch_id: int) -> None:
        rows = batch.select(
            "value",
            F.date_format(F.timestamp_millis("ts"), "yyyy-MM-dd").alias("dt"),
            F.lit(batch_id).alias("batch_id"))
        _replace_batch(rows, path, "text", "dt", "batch_id")
    return write


BAD = ["topic", "key", "value", "offset", "timestamp", "record", "reason"]


def bad_rows(path: str, job: str) -> Writer:
    """Unreadable messages of a job with topic, offset and reason; a replay writes the same once more."""
    def write(batch: DataFrame, batch_id: int) -> None:
        have = dict(batch.dtypes)
        kinds = {"offset": "bigint", "timestamp": "timestamp"}
        rows = batch.select(
            *[(F.col(c) if c in have else F.lit(None)).cast(kinds.get(c, "string")).alias(c) for c in BAD],
            F.lit(job).alias("job"), F.lit(batch_id).alias("batch_id"))
        _replace_batch(rows, path, "parquet", "job", "batch_id")
    return write


def topic_files(path: str, source: str = "parquet") -> Writer:
    """Routed messages to a folder per topic, read back by ``read_topic(source=...)``."""
    def write(batch: DataFrame, batch_id: int) -> None:
        have = set(batch.columns)
        rows = batch.select(
            "topic", "value",
            *[F.col(c) if c in have else F.lit(None).cast(t).alias(c)
              for c, t in (("key", "string"), ("offset", "bigint"), ("timestamp", "timestamp"))],
            F.lit(batch_id).alias("batch_id"))
        # the topics are few: the tasks of a large batch write a file for each without a shuffle of all messages
        _replace_batch(rows, path, source, "topic", "batch_id", gather=_small(rows))
    return write


def topic_kafka(servers: str, **options: str) -> Writer:
    """Routed messages to Kafka by their ``topic`` column; needs the Kafka package on the cluster."""
    def write(batch: DataFrame, batch_id: int) -> None:
        key = [F.col("key")] if "key" in batch.columns else []
        (batch.select("topic", "value", *key).write.format("kafka")
         .option("kafka.bootstrap.servers", servers).options(**options).save())
    return write


def observed(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """Count the rows that pass, in the same job that uses them."""
    seen = Observation(name)
    return df.observe(seen, F.count("*").alias("rows")), seen
