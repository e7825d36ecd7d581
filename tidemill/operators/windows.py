"""Sliding windows over device events."""

from __future__ import annotations

from math import ceil, gcd

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemill.operators.keyed import spread_join

# Event kinds of the shop's app.
COUPON = "coupon"
CLICK = "clickItem"
# A block of windows is this many window lengths long; a longer block repeats fewer panes.
BLOCK = 4


def _floor(value: Column, step: int) -> Column:
    return value - F.pmod(value, F.lit(step))


def panes(events: DataFrame, size: int, slide: int, at: str = "event_time", length: int | None = None) -> DataFrame:
    """(mid, pane, evid, uid, itemid, n): events counted by pane, the longest step that divides size and slide.

    User and item are kept of coupons only; other events of a device, pane and kind are one row.
    """
    pane = _floor(F.unix_seconds(at), length or gcd(size, slide))
    return events.withColumn("pane", pane).groupBy("mid", "pane", "evid", *_coupon_fields()).agg(F.count("*").alias("n"))


def _coupon_fields() -> list[Column]:
    return [F.when(F.col("evid") == COUPON, F.col(c)).alias(c) for c in ("uid", "itemid")]


def _pieces(rows: DataFrame, size: int, slide: int) -> DataFrame:
    """The windows ``lo`` to ``hi`` that a pane lies in, cut at the edges of blocks; window w starts at w * slide."""
    first = (_floor(F.col("pane") - size, slide) + slide) / slide
    last = _floor(F.col("pane"), slide) / slide
    per_block = BLOCK * ceil(size / slide)
    begin = F.col("block") * per_block
    return (
        rows.withColumn("lo", first.cast("bigint")).withColumn("hi", last.cast("bigint"))
        .where("lo <= hi")  # with gaps between the windows, a pane may lie in none
        .withColumn("block", F.explode(F.sequence(
            F.floor(F.col("lo") / per_block), F.floor(F.col("hi") / per_block))))
        .withColumn("lo", F.greatest("lo", begin)).withColumn("hi", F.least("hi", begin + (per_block - 1))))


def user_counts(counted: DataFrame, size: int, slide: int) -> DataFrame:
    """(mid, block, lo, hi, users, clicks): the distinct coupon users of every window, by a sweep over time.

    The panes of a user on a device are ranges of windows. Where they overlap or meet they are one range, of which only
    the two ends count: +1 where it begins, -1 behind its end. The steps are summed by place, and their running sum is
    the number of users of all windows up to the next step. Clicks are swept along as one more user. Neither a
    window nor a set of users is ever made; a busy device is split by blocks of windows.
    """
    per_block = BLOCK * ceil(size / slide)
    is_click = F.col("evid") == CLICK
    marks = counted.where(is_click | (F.col("uid").isNotNull())).select("mid", "pane", "uid").distinct()
    own = Window.partitionBy("mid", "uid", "block").orderBy("lo", "hi")
    before, after = F.lag("hi").over(own), F.lead("lo").over(own)
    begins = F.when(before.isNull() | (F.col("lo") > before + 1), F.struct(F.col("lo").alias("at"), F.lit(1).alias("step")))
    ends = F.when(after.isNull() | (after > F.col("hi") + 1),
                  F.struct((F.col("hi") + 1).alias("at"), F.lit(-1).alias("step")))
    block_end = (F.col("block") + 1) * per_block
    steps = (
        _pieces(marks, size, slide).select("mid", "uid", "block", F.array(begins, ends).alias("edges"))
        .select("mid", "uid", "block", F.inline(F.filter("edges", lambda e: e.isNotNull())))
        .where(F.col("at") < block_end)
        .groupBy("mid", "block", "at").agg(
            F.sum(F.when(F.col("uid").isNotNull(), F.col("step"))).alias("user_step"),
            F.sum(F.when(F.col("uid").isNull(), F.col("step"))).alias("click_step")))
    in_time = Window.partitionBy("mid", "block").orderBy("at")
    so_far = in_time.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return steps.select(
        "mid", "block", F.col("at").alias("lo"),
        (F.coalesce(F.lead("at").over(in_time), block_end) - 1).alias("hi"),
        F.coalesce(F.sum("user_step").over(so_far), F.lit(0)).alias("users"),
        F.coalesce(F.sum("click_step").over(so_far), F.lit(0)).alias("clicks"))


def windows_of(
    counted: DataFrame, size: int, slide: int, min_users: int = 0, clicked: bool = True
) -> DataFrame:
    """The windows of counted panes; only those with ``min_users`` users, and without a click unless ``clicked``.

    Which windows these are is told by :func:`user_counts`, before any set of users, items or events is collected.
    """
    pieces = _pieces(counted, size, slide)
    if min_users > 0 or not clicked:
        held = user_counts(counted, size, slide).where(F.col("users") >= min_users)
        if not clicked:
            held = held.where("clicks = 0")
        # a null device is a device, too
        held = held.select(
            F.struct("mid").alias("device"), "block", F.col("lo").alias("from"), F.col("hi").alias("to"))
        pieces = (
            spread_join(pieces.withColumn("device", F.struct("mid")), held, ["device", "block"], ["pane", "evid", "uid"],
                        "inner")
            .where("lo <= to and hi >= from")
            .withColumn("lo", F.greatest("lo", "from")).withColumn("hi", F.least("hi", "to")))
    tasks = int(counted.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    start = F.col("number") * slide
    return (
        # each pane travels once a block; a fixed number of tasks, as AQE would size them by what is yet to multiply
        pieces.select("mid", "block", "evid", "uid", "itemid", "n", "lo", "hi").repartition(tasks, "mid", "block")
        .withColumn("number", F.explode(F.sequence("lo", "hi")))
        # hash(mid, block) already brings these groups together: no further shuffle
        .groupBy("mid", "block", "number", "evid")
        .agg(F.sum("n").alias("n"), F.collect_set("uid").alias("uids"), F.collect_set("itemid").alias("items"))
        .groupBy("mid", "block", "number")
        .agg(
            # one entry for each kind of event; only that of coupons has users and items
            F.flatten(F.collect_list("uids")).alias("uids"), F.flatten(F.collect_list("items")).alias("items"),
            F.collect_list(F.struct("evid", "n")).alias("event_counts"),
            F.bool_or(F.col("evid") == CLICK).alias("clicked"))
        .select(
            "mid",
            F.timestamp_seconds(start).alias("window_start"),
            F.timestamp_seconds(start + size).alias("window_end"),
            F.array_sort("uids").alias("uids"),
            F.array_sort("items").alias("item_ids"),
            "event_counts",
            "clicked"))


def device_windows(
    events: DataFrame, size: int = 300, slide: int = 5, min_users: int = 0, at: str = "event_time"
) -> DataFrame:
    """Per device and sliding window (seconds): coupon users and items, event counts, click flag.

    A row belongs to ``size / slide`` windows. Rows are counted by pane first, which shrinks busy devices before any
    shuffle, and panes are dealt out to windows only inside a block of windows. With ``min_users``, the windows that
    have so many users are found first and nothing else is dealt out.
    """
    return windows_of(panes(events, size, slide, at), size, slide, min_users)


def event_list(counts: Column) -> Column:
    """(evid, n) counts back to the sorted list of all events."""
    return F.array_sort(F.flatten(F.transform(
        counts, lambda c: F.array_repeat(c["evid"], c["n"].cast("int")))))


def stream_panes(events: DataFrame, length: int, delay: str, at: str = "event_time") -> DataFrame:
    """The panes of a stream, as state that the watermark evicts.

    An event changes one row of state, whatever the number of windows it lies in; the windows are put together
    by :func:`windows_of` when they are read.
    """
    counted = (
        events.withWatermark(at, delay)
        .groupBy("mid", F.window(at, f"{length} seconds").alias("w"), "evid", *_coupon_fields())
        .agg(F.count("*").alias("n")))
    return counted.select(
        "mid", F.unix_seconds("w.start").alias("pane"), "evid", "uid", "itemid", "n")
