"""Topics: reading, decoding, stamping and routing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemill.functions.scalar import stamp_now
from tidemill.schemas import (
    RECORDS, TOPIC_COLUMNS, TOPIC_EVENT, TOPIC_STARTUP, TYPES,
)

CORRUPT = "_corrupt_record"
LOG_MAP = "map<string,variant>"


def read_topic(
    spark: SparkSession,
    topic: str,
    source: str = "kafka",
    path: str | None = None,
    per_trigger: int | None = None,
    **options: str,
) -> DataFrame:
    """A topic as a stream of ``TOPIC_COLUMNS``.

    ``source="kafka"`` starts at the latest offset, later runs at the checkpoint; it needs the Kafka
    package on the cluster. Any file source reads the same columns from ``path``. ``per_trigger`` bounds
    one micro-batch: offsets for Kafka, files otherwise.
    """
    reader = spark.readStream.format(source).options(**options)
    if source == "kafka":
        reader = reader.option("subscribe", topic)
        if "startingOffsets" not in options:
            reader = reader.option("startingOffsets", "latest")
        if per_trigger:
            reader = reader.option("maxOffsetsPerTrigger", per_trigger)
        rows = reader.load()
        return rows.select(
            "topic", F.col("key").cast("string").alias("key"),
            F.col("value").cast("string").alias("value"), "offset", "timestamp")
    if per_trigger:
        reader = reader.option("maxFilesPerTrigger", per_trigger)
    return reader.schema(TOPIC_COLUMNS).load(path).where(F.col("topic") == topic)


def _once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a costly column so that it is computed once per row.

    Catalyst would repeat a parse in every filter and field that uses it; it does not look into the
    output of a generator.
    """
    return df.withColumn(name, F.explode(F.array(value)))


def parse(df: DataFrame, record: str) -> DataFrame:
    """JSON lines in ``value`` read once, for :func:`good_rows` and :func:`bad_rows`."""
    fields = ", ".join(f"`{name}` string" for name in RECORDS[record])
    parsed = F.from_json(
        "value", f"{fields}, {CORRUPT} string",
        {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    return _once(df, "_record", parsed)


def _readable() -> Column:
    return F.col("_record").isNotNull() & F.col(f"_record.{CORRUPT}").isNull()


def good_rows(parsed: DataFrame, record: str, *keep: str) -> DataFrame:
    """The fields of a record, bound by name; ``keep`` names columns to carry."""
    types = TYPES[record]
    fields = []
    for name in RECORDS[record]:
        field = F.col(f"_record.{name}")
        fields.append((field.try_cast(types[name]) if name in types else field).alias(name))
    return parsed.where(_readable()).select(*fields, *keep)


def bad_rows(parsed: DataFrame, record: str) -> DataFrame:
    """The messages that could not be read, with the record they should have been and the reason."""
    return parsed.where(~_readable()).drop("_record").withColumn("record", F.lit(record)).withColumn(
        "reason", _reason())


def _reason() -> Column:
    return F.when(F.col("value").isNull(), "no value").when(F.trim("value") == "", "empty value").otherwise(
        "no JSON object")


def decode(df: DataFrame, record: str, *keep: str) -> DataFrame:
    """JSON lines in ``value`` to the fields of a record.

    Unreadable lines are left out here and returned by :func:`bad_records`.
    """
    return good_rows(parse(df, record), record, *keep)


def bad_records(df: DataFrame, record: str) -> DataFrame:
    """The lines :func:`decode` cannot read."""
    return bad_rows(parse(df, record), record)


def stamp_or_mark(lines: DataFrame, now: Column | None = None) -> DataFrame:
    """Put the server time into every JSON line of ``value``, over any ``ts`` of the client.

    All other fields are kept, known or not, with their types: numbers, booleans, lists and objects. Adds ``ts``, and
    ``type`` for the router. A line that is no JSON object stays as it is and gets a ``reason``.
    """
    at = stamp_now() if now is None else now
    log = F.col("_log")
    kept = F.map_filter(log, lambda k, v: (k != "ts") & v.isNotNull() & ~F.is_variant_null(v))
    stamped = F.map_concat(kept, F.create_map(F.lit("ts"), F.parse_json(F.col("ts").cast("string"))))
    return (
        _once(lines.withColumn("ts", at), "_log", F.from_json("value", LOG_MAP))
        .withColumn("reason", F.when(log.isNull(), _reason()))
        .withColumn("type", F.try_variant_get(F.try_element_at("_log", F.lit("type")), "$", "string"))
        .withColumn("value", F.when(log.isNotNull(), F.to_json(stamped)).otherwise(F.col("value")))
        .drop("_log")
    )


def stamp(lines: DataFrame, now: Column | None = None) -> DataFrame:
    """The lines that :func:`stamp_or_mark` could stamp; the others are :func:`bad_lines`."""
    return stamp_or_mark(lines, now).where("reason is null").drop("reason")


def bad_lines(lines: DataFrame) -> DataFrame:
    """Lines :func:`stamp` cannot read."""
    return stamp_or_mark(lines).where("reason is not null").drop("ts", "type")


def route_logs(stamped: DataFrame) -> DataFrame:
    """Startups to their topic, every other line to the event topic."""
    return stamped.withColumn(
        "topic", F.when(F.col("type") == "startup", TOPIC_STARTUP).otherwise(TOPIC_EVENT))
