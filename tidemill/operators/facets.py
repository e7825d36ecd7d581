"""Term buckets, shares and result pages over search hits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StructType

from tidemill.functions.scalar import percent
from tidemill.schemas import (
    AGE_COUNT_NAMES, AGE_SHARE_NAMES, AGE_TITLE, GENDER_NAMES, GENDER_TITLE,
)

TITLES = {"age": AGE_TITLE, "gender": GENDER_TITLE}
#: Rows that a task may hold to find a page, parts that a range is divided into, and rows drawn to divide it.
HELD = 10_000
PARTS = 32
SAMPLE = 4_096


def terms(hits: DataFrame, field: str, size: int) -> DataFrame:
    """The ``size`` most frequent values of a field, ties by value; rows without one do not count."""
    return (
        hits.where(F.col(field).isNotNull())
        .groupBy(F.col(field).alias("value"))
        .agg(F.count("*").alias("doc_count"))
        .orderBy(F.col("doc_count").desc(), F.col("value"))
        .limit(size)
    )


def total_hits(hits: DataFrame) -> DataFrame:
    return hits.agg(F.count("*").alias("total"))


def bands(hits: DataFrame, drop_unknown: bool = False) -> DataFrame:
    """One row with the hit count and the count of each age band and gender, from one pass.

    Sales without a user row have age 0 and no gender; they count as under 20 unless dropped.
    """
    if drop_unknown:
        hits = hits.where(F.col("user_gender").isNotNull())
    age = F.col("user_age")
    counts = [
        F.count_if(age < 20).alias("age_0"),
        F.count_if((age >= 20) & (age < 30)).alias("age_1"),
        F.count_if(age >= 30).alias("age_2"),
    ]
    counts += [F.count_if(F.col("user_gender") == g).alias(f"gender_{g}") for g in GENDER_NAMES]
    return hits.agg(F.count("*").alias("total"), *counts)


def options(kind: str) -> Column:
    """(name, percent) structs of one statistic, over a row of :func:`bands`."""
    named = (
        {f"age_{i}": name for i, name in enumerate(AGE_SHARE_NAMES)} if kind == "age"
        else {f"gender_{g}": name for g, name in GENDER_NAMES.items()})
    return F.array(*[
        F.struct(F.lit(name).alias("name"), percent(F.col(count), F.col("total")).alias("value"))
        for count, name in named.items()])


def _share(hits: DataFrame, kind: str, drop_unknown: bool) -> DataFrame:
    return bands(hits, drop_unknown).select(
        F.lit(TITLES[kind]).alias("title"), F.inline(options(kind)))


def age_share(hits: DataFrame, drop_unknown: bool = False) -> DataFrame:
    """Percent of the hits per age band."""
    return _share(hits, "age", drop_unknown)


def gender_share(hits: DataFrame, drop_unknown: bool = False) -> DataFrame:
    """Percent of the hits per gender."""
    return _share(hits, "gender", drop_unknown)


def demographics(hits: DataFrame, drop_unknown: bool = False) -> DataFrame:
    """Hit counts per age band and gender."""
    named = [("age", name, f"age_{i}") for i, name in enumerate(AGE_COUNT_NAMES)]
    named += [("gender", name, f"gender_{g}") for g, name in GENDER_NAMES.items()]
    groups = F.array(*[
        F.struct(F.lit(title).alias("title"), F.lit(name).alias("name"), F.col(count).alias("value"))
        for title, name, count in named])
    return bands(hits, drop_unknown).select(F.inline(groups))


def _order(rows: DataFrame, key: str) -> Column:
    """What pages are ordered by: the key, nulls first, and a hash of the row among equal keys."""
    return F.struct(F.col(key), F.xxhash64(*[F.col(c) for c in rows.columns]).alias("row"))


def _splits(ordered: DataFrame) -> list:
    """Places that divide the rows about evenly: those of a small sample drawn by hash, so the same on every run."""
    held = ordered.orderBy(F.xxhash64("at", F.lit(1)), "at").limit(SAMPLE)
    drawn = [r["at"] for r in held.select("at").orderBy("at").collect()]
    return list(dict.fromkeys(drawn[i * len(drawn) // PARTS] for i in range(1, PARTS))) if drawn else []


def _as_column(place, like: StructType) -> Column:
    return F.struct(*[
        F.lit(value).cast(field.dataType).alias(field.name) for value, field in zip(place, like.fields)])


def page(hits: DataFrame, number: int, size: int, key: str, held: int = HELD) -> DataFrame:
    """Page ``number`` (from 1) of ``size`` rows in key order; rows with equal keys go by a hash of the row.

    A page within the first ``held`` rows is taken as it is: each task keeps so many rows at most. A deeper one is found
    by rank. The range that holds it is divided at a few sampled places, the rows of every part are counted exactly,
    and the parts before the page are left out by their counts. When the page is within the first ``held`` rows of what
    is left, only that range is read and sorted. Each step makes the range some ``PARTS`` times smaller. Columns must
    be such as can be hashed, so no maps.
    """
    skip, low, high = (number - 1) * size, None, None
    place = _order(hits, key)
    ordered = hits.select(place.alias("at"))
    kind = ordered.schema["at"].dataType

    def within(at: Column) -> Column:
        inside = F.lit(True)
        if low is not None:
            inside = at >= _as_column(low, kind)
        if high is not None:
            inside = inside & (at < _as_column(high, kind))
        return inside

    if skip + size > held:
        ordered = ordered.persist()
    try:
        while skip + size > held:
            rest = ordered.where(within(F.col("at")))
            splits = [s for s in _splits(rest) if low is None or tuple(s) != tuple(low)]
            if not splits:  # rows that are equal in all columns: whichever are left out, the page is the same
                break
            part = F.lit(0)
            for s in splits:
                part = part + (F.col("at") >= _as_column(s, kind)).cast("int")
            counts = {r["part"]: r["n"] for r in rest.groupBy(part.alias("part")).agg(F.count("*").alias("n")).collect()}
            first, before = _part_of(counts, skip, len(splits))
            last, _ = _part_of(counts, skip + size - 1, len(splits))
            edges = [low, *splits, high]
            if (edges[first], edges[last + 1]) == (low, high):
                break
            low, high, skip = edges[first], edges[last + 1], skip - before
    finally:
        ordered.unpersist()
    # the bounds of the key alone as well, as a scan can use these
    if low is not None and low[0] is not None:
        hits = hits.where(F.col(key) >= F.lit(low[0]).cast(kind[0].dataType))
        if high is not None:
            hits = hits.where(F.col(key) <= F.lit(high[0]).cast(kind[0].dataType))
    return hits.where(within(place)).orderBy(place).offset(skip).limit(size)


def _part_of(counts: dict[int, int], row: int, last: int) -> tuple[int, int]:
    """The part that holds a row, and the rows before that part; the last part for a row past the end."""
    before = 0
    for part in range(last):
        if row < before + counts.get(part, 0):
            return part, before
        before += counts.get(part, 0)
    return last, before


def page_of_row(start: int, size: int) -> int:
    """The page that holds row offset ``start``."""
    return start // size + 1
