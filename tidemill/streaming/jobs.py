"""The Structured Streaming jobs. Each uses the batch plan of its pipeline on its micro-batches."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from math import gcd
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StructField, StructType

from tidemill.operators import postings, windows
from tidemill.operators.keyed import first_per_key, split
from tidemill.plans import alerts as alert_plan, dau as dau_plan, orders as order_plan, sales as sale_plan
from tidemill.schemas import DAU_TABLE, ORDER_TABLE, SALE_DETAIL, USER_STATE_TABLE, USER_TABLE, strings
from tidemill.session import job_session
from tidemill.sources import changes, topics
from tidemill.streaming import counters, sinks
from tidemill.streaming.tables import KeyedTable, delete, few_repeated, listed, read_repeated

EVERY = "5 seconds"
EachBatch = Callable[[DataFrame, int], None]
EachPair = Callable[[DataFrame], DataFrame]
Metrics = Callable[[int, dict[str, int]], None]


def start(
    stream: DataFrame, each_batch: EachBatch, checkpoint: str, mode: str = "append",
    every: str = EVERY, drain: bool = False,
) -> StreamingQuery:
    """Run a batch function on a stream; ``drain`` processes what is there and stops."""
    writer = (stream.writeStream.outputMode(mode).foreachBatch(each_batch)
              .option("checkpointLocation", checkpoint))
    writer = writer.trigger(availableNow=True) if drain else writer.trigger(processingTime=every)
    return writer.start()


def start_split(
    topic: DataFrame, record: str, keep: tuple[str, ...], each_good: EachBatch, checkpoint: str, bad: sinks.Writer | None,
    **run,
) -> StreamingQuery:
    """Run a batch function on the readable rows of a topic; unreadable ones go to ``bad``, both from one parse."""
    def each(batch: DataFrame, batch_id: int) -> None:
        if bad is None:
            each_good(topics.decode(batch, record, *keep), batch_id)
            return
        parsed = topics.parse(batch, record).persist()
        try:
            bad(topics.bad_rows(parsed, record), batch_id)
            each_good(topics.good_rows(parsed, record, *keep), batch_id)
        finally:
            parsed.unpersist()

    return start(topic, each, checkpoint, **run)


def bad_records(topic: DataFrame, record: str, bad: sinks.Writer, checkpoint: str, **run) -> StreamingQuery:
    """Store the unreadable rows of a topic. Jobs with stream state, which a batch function comes after, have this
    run beside them."""
    unreadable = topics.bad_records(topic, record)
    return start(unreadable, bad, checkpoint, **run)


# Tables ----------------------------------------------------------------------------------------------

def dau_table(path: str, **layout) -> KeyedTable:
    """The earliest startup of a device and day wins, whatever batch brought it."""
    return KeyedTable(path, DAU_TABLE, ("mid", "log_date"), ("ts", "batch_id"), "log_date", **layout)


def order_table(path: str) -> KeyedTable:
    return KeyedTable(path, ORDER_TABLE, ("id",), ("-batch_id",), "create_date")


def user_state_table(path: str) -> KeyedTable:
    """Set once per user; only an order from before the known first one moves it."""
    return KeyedTable(path, USER_STATE_TABLE, ("user_id",), ("first_time", "first_order_id", "batch_id"))


def user_table(path: str) -> KeyedTable:
    return KeyedTable(path, USER_TABLE, ("id",), ("-batch_id", "-offset"))


def sale_table(path: str) -> KeyedTable:
    return KeyedTable(path, SALE_DETAIL, ("order_detail_id",), ("-batch_id",), "dt")


POSTING = StructType(strings("token", "order_detail_id", "dt", "bucket"))


def posting_table(path: str) -> KeyedTable:
    """The words of the stored lines, in folders by word."""
    return KeyedTable(path, POSTING, ("token", "order_detail_id", "dt"), ("-batch_id",), "bucket")


PANE = StructType(
    strings("mid") + [StructField("pane", LongType())] + strings("evid", "uid", "itemid")
    + [StructField("n", LongType())] + strings("dt"))


def pane_table(path: str) -> KeyedTable:
    """Events counted by device, pane and kind, coupons by user and item as well; a later count replaces an earlier."""
    return KeyedTable(path, PANE, ("mid", "pane", "evid", "uid", "itemid"), ("-batch_id",), "dt")


# Ingest ----------------------------------------------------------------------------------------------

def ingest_logs(
    lines: DataFrame, archive_path: str, write_topics: sinks.Writer, checkpoint: str,
    now: Column | None = None, bad: sinks.Writer | None = None, **run,
) -> StreamingQuery:
    """Stamp log lines, archive them, and route them to their topics; lines that are no JSON object go to ``bad``.

    The stamp is part of the stream, where the clock is the batch's recorded time: a replayed batch gets
    the stamps, and so the archive day, of its first attempt.
    """
    writers = [sinks.archive(archive_path), write_topics]

    def each(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            if bad is not None:
                bad(batch.where("reason is not null").drop("topic").withColumn("record", F.lit("log")), batch_id)
            sinks.fan_out(batch.where("reason is null").drop("reason"), batch_id, writers)
        finally:
            batch.unpersist()

    return start(topics.route_logs(topics.stamp_or_mark(lines, now)), each, checkpoint, **run)


def ingest_changes(
    entries: DataFrame, pattern: str, write_topics: sinks.Writer, checkpoint: str, **run
) -> StreamingQuery:
    """Route row changes to their topics."""
    def each(batch: DataFrame, batch_id: int) -> None:
        if not batch.isEmpty():
            write_topics(changes.route_changes(batch, pattern), batch_id)

    return start(entries, each, checkpoint, **run)


# Daily active devices --------------------------------------------------------------------------------

def _of_days(rows: DataFrame, fresh: DataFrame) -> DataFrame:
    """Rows of the days at hand; the scan leaves out other days once these are known, however far apart they lie."""
    # a filter that all days pass, as only a filtered side prunes the partitions of the other
    days = fresh.select("log_date").where(F.col("log_date") > "").distinct()
    return rows.join(days, "log_date", "left_semi")


def dau(
    topic: DataFrame, table: KeyedTable, checkpoint: str, on_metrics: Metrics | None = None,
    counted_at: counters.DeviceCounters | None = None, bad: sinks.Writer | None = None, **run
) -> StreamingQuery:
    """Keep the first startup of each device and day; with ``counted_at``, also the counters of the KPI board.

    A device is dropped when the table holds a startup of the day that is no later, so a late, earlier
    startup still replaces the stored one. Only the days of the batch are read, and only rows of earlier
    batches, so a replay sees what the first attempt saw.
    """
    def each(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        counted, before = sinks.observed(dau_plan.with_day(batch), f"startups_{batch_id}")
        fresh = dau_plan.first_startup(counted).persist()
        try:
            if fresh.isEmpty():
                return
            seen = (
                _of_days(table.rows(spark, before=batch_id), fresh)
                .groupBy(*dau_plan.DEVICE_DAY).agg(F.min("ts").alias("seen_ts")))
            if counted_at is not None:
                counters.add_devices(counted_at, fresh, seen, batch_id)
            later = [fresh[k] == seen[k] for k in dau_plan.DEVICE_DAY]
            kept, after = sinks.observed(
                fresh.join(seen, [*later, seen["seen_ts"] <= fresh["ts"]], "left_anti"),
                f"devices_{batch_id}")
            table.upsert(kept, batch_id)
            if on_metrics:
                on_metrics(batch_id, {"startups": before.get["rows"], "devices": after.get["rows"]})
        finally:
            fresh.unpersist()

    return start_split(topic, "startup_log", (), each, checkpoint, bad, **run)


def dau_append_only(
    topic: DataFrame, path: str, checkpoint: str, delay: str = "24 hours", drain: bool = False,
    every: str = EVERY,
) -> StreamingQuery:
    """Variant without table reads: the first *arrived* startup of a device and day, from stream state.

    State is kept for ``delay`` beyond the newest event, at least a day, so no device of a running day
    is forgotten.
    """
    startups = dau_plan.with_day(topics.decode(topic, "startup_log")).withColumn(
        "event_time", F.timestamp_millis("ts"))
    firsts = startups.withWatermark("event_time", delay).dropDuplicatesWithinWatermark(
        dau_plan.DEVICE_DAY)
    writer = (firsts.select(*DAU_TABLE.names).writeStream.format("parquet").option("path", path)
              .option("checkpointLocation", checkpoint).partitionBy("log_date"))
    writer = writer.trigger(availableNow=True) if drain else writer.trigger(processingTime=every)
    return writer.start()


# Orders ----------------------------------------------------------------------------------------------

def orders(
    topic: DataFrame, table: KeyedTable, checkpoint: str, counts_at: KeyedTable | None = None,
    bad: sinks.Writer | None = None, **run
) -> StreamingQuery:
    """Store prepared orders by id; with ``counts_at``, also keep the amount of each day."""
    def each(batch: DataFrame, batch_id: int) -> None:
        newest = first_per_key(order_plan.prepare(batch), ["id"], [F.col("offset").desc_nulls_last()])
        if counts_at is not None:
            newest = newest.persist()
        try:
            if counts_at is not None:
                stored = table.read(batch.sparkSession, before=batch_id, wanted=newest)
                counters.add_orders(counts_at, newest, stored, batch_id)
            table.upsert(newest, batch_id)
        finally:
            newest.unpersist()

    return start_split(topic, "order_info", ("offset",), each, checkpoint, bad, **run)


def user_state(topic: DataFrame, table: KeyedTable, checkpoint: str, **run) -> StreamingQuery:
    """Remember each user's first order.

    The state lives in the state store: a batch costs what it brings, not the number of known users, and
    a user with very many orders is combined before the shuffle.
    """
    first = (
        topics.decode(topic, "order_info")
        .groupBy("user_id").agg(F.min(F.struct("create_time", "id")).alias("first"))
        .select("user_id", F.lit("1").alias("if_ordered"),
                F.col("first.create_time").alias("first_time"), F.col("first.id").alias("first_order_id")))
    return start(first, table.upsert, checkpoint, mode="update", **run)


def flagged_orders(spark: SparkSession, orders_at: KeyedTable, state_at: KeyedTable) -> DataFrame:
    """The orders with their first-order flag.

    The flag follows from the state when read, so an earlier order that arrives late takes the flag over
    from the order that held it.
    """
    first = state_at.read(spark).select(F.col("first_order_id").alias("id"))
    return order_plan.mark(orders_at.read(spark), first)


# Sales -----------------------------------------------------------------------------------------------

def users(
    topic: DataFrame, table: KeyedTable, checkpoint: str, bad: sinks.Writer | None = None, **run
) -> StreamingQuery:
    """Keep the newest row of each user; inserts and updates alike, never expired."""
    def each(batch: DataFrame, batch_id: int) -> None:
        table.upsert(sale_plan.latest_users(batch, "offset"), batch_id)

    return start_split(topic, "user_info", ("offset",), each, checkpoint, bad, **run)


def sales(
    order_topic: DataFrame, detail_topic: DataFrame, users_at: KeyedTable, table: KeyedTable,
    checkpoint: str, as_of: str | None = None, within: str = "1 hour", delay: str = "1 hour",
    salts: int = 1, index: KeyedTable | None = None, **run,
) -> StreamingQuery:
    """Pair orders and lines whatever comes first, add the current user, store by line id.

    The rows of a batch are joined as a batch with those that wait from earlier ones. Both sides wait, in a folder for
    each batch under the checkpoint, until the watermark shows that no partner can follow: the lesser of the newest
    times of the two sides, less ``delay``. The time of a record is its topic timestamp; records at or behind the
    watermark of the batches before are late. With ``index``, the words of the product names are stored as well, before
    the lines, so that no stored line is missed.

    The lines of a batch are shuffled once, to their orders, where AQE splits an order of very many lines without
    ``salts``. The orders bring the profile of their user, and the sales are written where they lie.
    """
    order_rows, detail_rows = _timed_sides(order_topic, detail_topic)
    both = (
        order_rows.select(F.lit("order").alias("side"), "id", "order_status", "create_time", "user_id", "order_ts")
        .unionByName(
            detail_rows.select(F.lit("line").alias("side"), "id", "order_id", "sku_id", "sku_name", "order_price",
                               "detail_ts"),
            allowMissingColumns=True))
    waiting = WaitingRows(f"{checkpoint}/waiting", both.schema)

    def each(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            if not batch.isEmpty():
                _pair_batch(batch, batch_id)
        finally:
            batch.unpersist()

    def _pair_batch(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        # the day belongs to the stream: a batch that is replayed after midnight keeps its ages
        day = batch.select("as_of_day").first()[0]
        held = waiting.before(spark, batch_id)
        edge = _watermark(held, delay)
        at = F.unix_micros(F.coalesce("order_ts", "detail_ts"))
        fresh = batch.drop("as_of_day")
        if edge is not None:
            fresh = fresh.where(at.isNull() | (at > edge))
        rows = fresh.withColumn("fresh", F.lit(True)).unionByName(held.withColumn("fresh", F.lit(False)))
        placed = rows.where("side = 'order'").withColumnRenamed("fresh", "fresh_order")
        lines = rows.where("side = 'line'").withColumnRenamed("fresh", "fresh_line")

        # two rows that both waited met in an earlier batch
        def paired(some: DataFrame) -> DataFrame:
            pairs = sale_plan.pair(
                known, some, within, salts, ("fresh_order", *sale_plan.PROFILE), ("fresh_line",))
            return pairs.where("fresh_order OR fresh_line").drop("fresh_order", "fresh_line")

        buyers = placed.select(F.col("user_id").alias("id")).distinct().persist()
        hashes = f"{checkpoint}/repeated"
        again = read_repeated(spark, hashes) if few_repeated(lines.select("id"), hashes) else None
        try:
            # once counted, the size of the keys is known and Spark chooses the lookup by it
            buyers.count()
            known = sale_plan.with_profile(placed, users_at.read(spark, wanted=buyers), "id")
            unique = _first_sales(paired, lines, again)
            _store_sales(sale_plan.aged(unique, F.lit(day)), batch_id, table, index, gather=False)
        finally:
            buyers.unpersist()
        left = rows.drop("fresh").where(at.isNotNull())
        following = _watermark(left, delay)
        if following is not None:
            oldest = F.timestamp_micros(F.lit(following)) - F.expr(f"INTERVAL {within}")
            left = left.where(F.coalesce("order_ts", "detail_ts") > oldest)
        waiting.store(left, batch_id)

    return start(both.withColumn("as_of_day", _day(as_of)), each, checkpoint, **run)


def _watermark(rows: DataFrame, delay: str) -> int | None:
    """The lesser of the newest times of the two sides less ``delay``, in whole milliseconds, as microseconds; none
    until both have come."""
    back = F.expr(f"INTERVAL {delay}")
    newest = rows.agg(*[F.unix_millis(F.max(c) - back) for c in ("order_ts", "detail_ts")]).first()
    return None if None in tuple(newest) else min(newest) * 1000


@dataclass(frozen=True)
class WaitingRows:
    """The rows that wait after each batch, a folder a batch; that of the batch before stays for a replay."""

    path: str
    schema: StructType

    def _numbers(self, spark: SparkSession) -> list[int]:
        return sorted(int(name.split("=")[1]) for name in listed(spark, self.path) if name.startswith("after="))

    def before(self, spark: SparkSession, batch_id: int) -> DataFrame:
        found = [n for n in self._numbers(spark) if n < batch_id]
        if not found:
            return spark.createDataFrame([], self.schema)
        return spark.read.schema(self.schema).parquet(f"{self.path}/after={found[-1]}")

    def store(self, rows: DataFrame, batch_id: int) -> None:
        spark = rows.sparkSession
        rows.hint("rebalance").write.mode("overwrite").parquet(f"{self.path}/after={batch_id}")
        for n in [n for n in self._numbers(spark) if n < batch_id][:-1]:
            delete(spark, f"{self.path}/after={n}")


def repair_sales(
    order_topic: DataFrame, detail_topic: DataFrame, users_at: KeyedTable, table: KeyedTable,
    repairs: KeyedTable, run_id: int, as_of: str | None = None, within: str = "1 hour", salts: int = 1,
    index: KeyedTable | None = None,
) -> None:
    """Store the sales that the stream let go because a side came behind its watermark.

    The topics are read as batches, for instance those of some days; of their lines only the ones in neither table
    are paired, by the condition of the stream; they are found and written first, so that the shuffle of all lines
    does not stand beside that of all orders. The sales go to a table of their own, as a table belongs to one
    writer; ``run_id`` numbers the runs, and a run that is made again replaces its first attempt. Lines that still
    wait in the stream may be stored by both: ``all_sales`` reads each line once. ``index`` is one of the repairs.
    """
    spark = detail_topic.sparkSession
    order_rows, detail_rows = _timed_sides(order_topic, detail_topic)
    # ids only: a line stored more than once is as well known as one stored once
    known = table.rows(spark).select("order_detail_id").unionByName(
        repairs.rows(spark, before=run_id).select("order_detail_id"))
    lines = sale_plan.as_details(detail_rows)
    missing = lines.join(known, lines["order_detail_id"].eqNullSafe(known["order_detail_id"]), "left_anti")
    aside = f"{repairs.path}/missing-{uuid4().hex}"
    missing.write.parquet(aside)
    # read twice below, and what is behind it must not be
    pairs = sale_plan.pair(order_rows, spark.read.schema(missing.schema).parquet(aside), within, salts)
    unique = _first_by(pairs, "order_detail_id").persist()
    buyers = unique.select(F.col("user_id").alias("id")).distinct().persist()
    try:
        # once counted, the size of the keys is known and Spark chooses the lookup by it
        buyers.count()
        profiles = users_at.read(spark, wanted=buyers)
        _store_sales(sale_plan.enrich(unique, profiles, _day(as_of)), run_id, repairs, index)
    finally:
        buyers.unpersist()
        unique.unpersist()
        delete(spark, aside)


def all_sales(spark: SparkSession, table: KeyedTable, repairs: KeyedTable, whole: bool = False) -> DataFrame:
    """The sales of the stream and those repaired since, one row a line; the stream's row goes before. ``whole`` as in
    :meth:`KeyedTable.read`."""
    stored, mended = table.rows(spark), repairs.rows(spark)

    def merged(stored: DataFrame, mended: DataFrame) -> DataFrame:
        ids = stored.select(F.col("order_detail_id").alias("stored_id"))
        missing = table.winners(mended).join(
            ids, F.col("order_detail_id").eqNullSafe(F.col("stored_id")), "left_anti")
        return table.winners(stored).unionByName(missing)

    path, own = f"{table.path}/repeated-{uuid4().hex}", job_session(spark) if whole else spark
    if not whole or not few_repeated(
            table.rows(own).unionByName(repairs.rows(own)).select("order_detail_id"), path):
        return merged(stored, mended).select(*SALE_DETAIL.names)
    hashes = read_repeated(spark, path)
    (one, others), (late, late_others) = (split(rows, ["order_detail_id"], hashes) for rows in (stored, mended))
    return one.unionByName(late).unionByName(merged(others, late_others)).select(*SALE_DETAIL.names)


def _timed_sides(order_topic: DataFrame, detail_topic: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Orders and lines with the times of their records."""
    orders = topics.decode(order_topic, "order_info", "timestamp").withColumnRenamed("timestamp", "order_ts")
    lines = topics.decode(detail_topic, "order_detail", "timestamp").withColumnRenamed("timestamp", "detail_ts")
    return orders, lines


def _day(as_of: str | None) -> Column:
    return F.current_date() if as_of is None else F.lit(as_of)


#: Of several orders that a line meets, the first of these.
SALE_ORDER = ("create_time", "order_id")


def _first_by(pairs: DataFrame, *keys: str) -> DataFrame:
    return first_per_key(pairs, keys, [F.col(c) for c in SALE_ORDER])


def _first_sales(paired: EachPair, lines: DataFrame, again: DataFrame | None) -> DataFrame:
    """One sale a line id. ``again`` are hashes of the ids that come more than once among the lines, None if many: a line
    of another id can only meet several rows of its own order, which lie where it met them."""
    if again is None:
        return _first_by(paired(lines), "order_detail_id")
    if again.isEmpty():
        return _first_by(paired(lines), "order_id", "order_detail_id")
    alone, others = split(lines, ["id"], again)
    return _first_by(paired(alone), "order_id", "order_detail_id").unionByName(
        _first_by(paired(others), "order_detail_id"))


def _store_sales(
    sales: DataFrame, batch_id: int, table: KeyedTable, index: KeyedTable | None, gather: bool = True,
) -> None:
    if index is not None:
        # read twice below, and what is behind it must not be
        sales = sales.persist()
    try:
        if index is not None:
            index.upsert(postings.postings(sales), batch_id)
        table.upsert(sales, batch_id, gather)
    finally:
        if index is not None:
            sales.unpersist()


# Alerts ----------------------------------------------------------------------------------------------

def alerts(
    topic: DataFrame, table: KeyedTable, checkpoint: str, size: int = 300, slide: int = 5,
    delay: str = "5 minutes", **run,
) -> StreamingQuery:
    """Count the events by pane, for windows of this size and slide or any others made of such panes."""
    events = topics.decode(topic, "event_log").withColumn("event_time", F.timestamp_millis("ts"))
    counted = windows.stream_panes(events, gcd(size, slide), delay)
    dated = counted.withColumn("dt", F.date_format(F.timestamp_seconds("pane"), "yyyy-MM-dd"))
    return start(dated, table.upsert, checkpoint, mode="update", **run)


def current_alerts(
    spark: SparkSession, table: KeyedTable, size: int = 300, slide: int = 5,
    min_users: int = alert_plan.MIN_USERS, day: str | None = None,
) -> DataFrame:
    """One alert per device and minute from the stored panes; ``day`` reads that day's panes and those of windows
    that reach into it."""
    rows = table.read(spark)
    if day is not None:
        first = F.date_format(F.timestamp_seconds(F.unix_timestamp(F.lit(day), "yyyy-MM-dd") - size), "yyyy-MM-dd")
        rows = rows.where(F.col("dt").between(first, F.lit(day)))
    found = alert_plan.per_minute(alert_plan.alerts_of(rows.drop("dt"), size, slide, min_users))
    return found if day is None else found.where(F.col("dt") == day)
