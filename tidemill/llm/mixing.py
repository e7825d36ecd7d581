"""Mixing sources to target weights by pivotal dependent rounding.

A source's target of words divided by its size is the expected number of copies of each of its documents. The
whole part is taken; the fractional parts are rounded in pairs: mass in words moves at random from one document to
the other until one of them is at 0 or 1, so the words of the source stay what they were. Chunks of a source are
rounded in parallel and leave one open document each, and a reduction tree rounds those, ``FAN`` chunks at a time,
until each source has at most one left, which goes to the nearer side.

Randomness is a hash of seed, document and level: reruns agree. A document is a row; rows that repeat an id are
told apart by their order of text hash, so each gets copies of its own. Null and empty texts have size 0, take
nothing and are mixed in no number of copies; a source without words has target 0. A null source is a source of
its own, the last in order; null ids are kept. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from tidemill.llm.common import WORD, mix64, stored

WEIGHTS = (5.0, 2.0, 1.0)
MOST_COPIES = 3
CHUNK = 4096
FAN = 64
_OPEN = "source_no long, chunk long, doc_key long, doc_id long, occurrence int, size long, p double"


def n_words(column: str = "text"):
    return F.coalesce(F.regexp_count(column, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: float = MOST_COPIES) -> DataFrame:
    """source, source_no, source_size, n_docs, target for each source of ``sizes`` (source, size).

    Shares by weight, held at ``most`` times the source's size, the excess shared among the others by
    weight: the level L at which the sum of least(cap, weight * L) is the total. The windows run over one row
    per source.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_docs"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    numbered = totals.withColumn("source_no", (F.row_number().over(by_name) - 1).cast("long"))
    weight = F.get(F.array(*[F.lit(float(w)) for w in weights]), (F.col("source_no") % len(weights)).cast("int"))
    capped = numbered.withColumn("weight", weight).withColumn("cap", F.col("source_size") * float(most))
    everything = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    order = Window.orderBy(F.col("cap") / F.col("weight"), "source_no")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    levelled = capped.withColumns({
        "k": F.row_number().over(order),
        "level": (F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
        / (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))})
    fits = F.when(F.col("level") <= F.col("cap") / F.col("weight"), F.struct("k", "level"))
    found = levelled.withColumn("at", F.min(fits).over(everything))
    share = F.col("weight") * F.coalesce(F.col("at.level"), F.lit(float("inf")))
    return found.select("source", "source_no", "source_size", "n_docs", F.least("cap", share).alias("target"))


def _rounding(seed: int, level: int, last: bool):
    def run(table: pa.Table) -> pa.Table:
        return _round(table, seed, level, last)
    return run


def _round(table: pa.Table, seed: int, level: int, last: bool) -> pa.Table:
    """Round the documents of one group; at most one is left open, none if ``last``."""
    frame = table.to_pandas().sort_values(["size", "doc_key"], ascending=[False, True], kind="stable")
    key, size = frame["doc_key"].to_numpy().astype(np.uint64), frame["size"].to_numpy().astype(float)
    p = frame["p"].to_numpy().copy()
    base = np.uint64((seed * 1_000_003 + level * 7919) & 0xFFFFFFFFFFFFFFFF)
    coin = (mix64(key + mix64(np.full(len(p), base, dtype=np.uint64))) >> np.uint64(11)).astype(float) / 2**53
    open_ = -1
    for i in range(len(p)):
        if not 0.0 < p[i] < 1.0:
            continue
        if open_ < 0:
            open_ = i
            continue
        a, b = open_, i
        up = min((1.0 - p[a]) * size[a], p[b] * size[b])
        down = min(p[a] * size[a], (1.0 - p[b]) * size[b])
        # mass moves from b to a with a probability that keeps every expectation
        moved = up if coin[i] * (up + down) < down else -down
        pa_, pb = p[a] + moved / size[a], p[b] - moved / size[b]
        p[a], p[b] = (round(v) if abs(v - round(v)) < 1e-9 else v for v in (pa_, pb))
        open_ = a if 0.0 < p[a] < 1.0 else b if 0.0 < p[b] < 1.0 else -1
    if last and open_ >= 0:
        p[open_] = float(p[open_] >= 0.5)
    frame["p"] = p
    return pa.Table.from_pandas(frame, schema=table.schema, preserve_index=False)


def copies(docs: DataFrame, seed: int = 1, weights: tuple[float, ...] = WEIGHTS) -> DataFrame:
    """doc_id, occurrence, size, source_size, target, copies: a row for every row of ``docs`` (doc_id, source, text)."""
    spark = docs.sparkSession
    # 12 bytes a row stand for the text from here on
    sizes = stored(docs.select(
        "doc_id", "source", n_words().alias("size"), F.xxhash64("text").alias("text_hash")), "mix-sizes")
    numbered = with_occurrence(sizes, F.col("text_hash"))
    plan = stored(targets(sizes), "mix-targets")
    dealt = numbered.join(plan, numbered["source"].eqNullSafe(plan["source"])).select(
        "doc_id", "occurrence", "size", "source_no", "source_size", "n_docs", "target",
        F.xxhash64("doc_id", "occurrence", F.lit(seed)).alias("doc_key"))
    expected = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    dealt = dealt.withColumn("whole", F.when(F.col("size") > 0, F.floor(expected)).otherwise(0).cast("long"))
    dealt = stored(dealt.withColumn("p", F.when(F.col("size") > 0, expected - F.col("whole")).otherwise(0.0)), "mix-dealt")

    chunks = F.greatest(F.ceil(F.col("n_docs") / CHUNK), F.lit(1))
    open_ = dealt.where("p > 0").select(
        "source_no", F.pmod("doc_key", chunks).alias("chunk"), "doc_key", "doc_id", "occurrence", "size", "p")
    width = plan.agg(F.max(F.ceil(F.col("n_docs") / CHUNK))).first()[0] or 1
    settled, level = [], 0
    while True:
        last = width <= 1
        done = stored(open_.groupBy("source_no", "chunk").applyInArrow(
            _rounding(seed, level, last), _OPEN), f"mix-level{level}")
        settled.append(done.where("p = 0 or p = 1"))
        if last:
            break
        open_ = done.where("p > 0 and p < 1").withColumn("chunk", F.floor(F.col("chunk") / FAN))
        width, level = -(-width // FAN), level + 1
    extra = settled[0]
    for more in settled[1:]:
        extra = extra.unionByName(more)
    extra = extra.where("p = 1").select(
        F.col("doc_key").alias("key"), F.col("doc_id").alias("drawn"), F.col("occurrence").alias("number"),
        F.lit(1).cast("long").alias("extra"))
    # the key deals the rows; two rows may share it by chance, but not their id and number
    same = (F.col("doc_key") == F.col("key")) & F.col("doc_id").eqNullSafe(F.col("drawn")) & (
        F.col("occurrence") == F.col("number"))
    return dealt.join(extra, same, "left").select(
        "doc_id", "occurrence", "size", "source_size", "target",
        (F.col("whole") + F.coalesce("extra", F.lit(0))).alias("copies"))


def with_occurrence(rows: DataFrame, text_hash) -> DataFrame:
    """Number the rows of an id, so that a repeated id names one row."""
    order = Window.partitionBy("doc_id").orderBy(F.col("source").asc_nulls_last(), text_hash)
    return rows.withColumn("occurrence", F.row_number().over(order))


def mix(docs: DataFrame, seed: int = 1) -> DataFrame:
    """``docs`` with every row repeated as often as it was drawn, none for those not drawn."""
    drawn = copies(docs.select("doc_id", "source", "text"), seed).where("copies > 0").select(
        F.col("doc_id").alias("drawn_id"), F.col("occurrence").alias("drawn_no"), "copies")
    # columns go by number, so that no name can clash
    place = {c: f"c{i}" for i, c in enumerate(docs.columns)}
    own = docs.toDF(*place.values()).withColumns(
        {"doc_id": F.col(place["doc_id"]), "source": F.col(place["source"])})
    rows = with_occurrence(own, F.xxhash64(place["text"]))
    joined = rows.join(drawn, rows["doc_id"].eqNullSafe(drawn["drawn_id"]) & (rows["occurrence"] == drawn["drawn_no"]))
    repeated = joined.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    return repeated.select(*[F.col(n).alias(c) for c, n in place.items()])
