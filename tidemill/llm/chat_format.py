"""Chat formatting: cumulative snapshots collapse into the longest logged conversation, then turns are rendered.

A log often holds a conversation anew after every turn. A rolling hash of the turns so far names each prefix;
a conversation whose whole hash is a proper prefix of another's is covered by that one and goes. Equal
conversations cover neither each other nor themselves: both stay.

A conversation is the set of its (turn, role, text) rows in the order of ``turn``; repeated rows count once.
Rows of one turn count as one step and are rendered by role, then text. Nulls come first and are equal to
each other, also as conv_id; a null role is rendered as ``unknown``, a null text as empty. An empty table gives
an empty result; columns beside the four are ignored.

Turns are handled in segments of ``SEGMENT`` turn numbers, so that a conversation with a third of all rows is
spread over many tasks; each segment is one rendered part.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

SEGMENT = 1024
SALTS = 8
_HASHES = {"h1": 11, "h2": 23}


def _with_prefixes(turns: DataFrame) -> DataFrame:
    """Each turn with the hash and count of the rows up to it (p1, p2, upto)."""
    # the seed comes first: hashed last, both hashes would follow from one value of 64 bits
    hashed = turns.withColumns({k: F.xxhash64(F.lit(seed), "turn", F.coalesce("role", F.lit("\0")), F.coalesce(
        "text", F.lit("\0"))) for k, seed in _HASHES.items()})
    inside = Window.partitionBy("conv_id", "segment").orderBy(F.col("turn").asc_nulls_first()).rangeBetween(
        Window.unboundedPreceding, Window.currentRow)
    rolled = hashed.withColumns({"r1": F.bit_xor("h1").over(inside), "r2": F.bit_xor("h2").over(inside),
                                 "rows": F.count("*").over(inside)})
    segments = hashed.groupBy("conv_id", "segment").agg(
        F.bit_xor("h1").alias("s1"), F.bit_xor("h2").alias("s2"), F.count("*").alias("rows"))
    before = Window.partitionBy("conv_id").orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("conv_id")
    offsets = segments.select(
        F.col("conv_id").alias("o_id"), F.col("segment").alias("o_segment"),
        F.coalesce(F.bit_xor("s1").over(before), F.lit(0)).alias("o1"),
        F.coalesce(F.bit_xor("s2").over(before), F.lit(0)).alias("o2"),
        F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("o_rows"), F.sum("rows").over(whole).alias("total"))
    same = F.col("conv_id").eqNullSafe(F.col("o_id")) & (F.col("segment") == F.col("o_segment"))
    return rolled.join(offsets, same).select(
        "conv_id", "segment", "turn", F.col("r1").bitwiseXOR(F.col("o1")).alias("p1"),
        F.col("r2").bitwiseXOR(F.col("o2")).alias("p2"), (F.col("rows") + F.col("o_rows")).alias("upto"), "total")


def turns_of(conversations: DataFrame) -> DataFrame:
    """The distinct turns with their segment."""
    rows = conversations.select("conv_id", "turn", "role", "text", F.coalesce(
        F.floor(F.col("turn") / SEGMENT).cast("long"), F.lit(-1)).alias("segment"))
    return rows.distinct()


def maximal(turns: DataFrame) -> DataFrame:
    """conv_id of the conversations that are a proper prefix of no other one."""
    prefixes = _with_prefixes(turns)
    proper = prefixes.where("upto < total").select("p1", "p2").distinct()
    full = prefixes.where("upto = total").select("conv_id", "p1", "p2").distinct()
    # many conversations may share one hash: they are dealt over salts, and so are the prefixes
    salted = proper.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    full = full.withColumn("salt", F.pmod(F.xxhash64("conv_id"), F.lit(SALTS)).cast("int"))
    return full.join(salted, ["p1", "p2", "salt"], "left_anti").select("conv_id")


def render(turns: DataFrame) -> DataFrame:
    """conv_id, part, n_turns, text: the turns of each segment between their marks."""
    marked = F.concat(F.lit("<|im_start|>"), F.coalesce("role", F.lit("unknown")), F.lit("\n"),
                      F.coalesce("text", F.lit("")), F.lit("<|im_end|>\n"))
    key = F.struct("turn", "role", "text", marked.alias("marked"))
    parts = turns.groupBy("conv_id", F.col("segment").alias("part")).agg(F.array_sort(F.collect_list(key)).alias("rows"))
    return parts.select("conv_id", "part", F.size("rows").cast("long").alias("n_turns"),
                        F.array_join("rows.marked", "").alias("text"))


def format_chats(conversations: DataFrame) -> DataFrame:
    """The maximal conversations, rendered."""
    turns = turns_of(conversations)
    kept = maximal(turns).select(F.col("conv_id").alias("kept_id"))
    return render(turns.join(kept, F.col("conv_id").eqNullSafe(F.col("kept_id")), "left_semi"))
