"""URL filters: host and path rules first, then a list of canonical URLs behind a blocked Bloom filter.

The filter is a table with a row per 64-bit block. A URL that misses it is on no list; the others go to an
exact hash join with the list, which removes the false positives. Neither table carries a broadcast hint:
Spark broadcasts what it has sized, and splits a hot URL or block otherwise.

Defined results: a null URL, or one without ``://``, has an empty host and path, fits no rule, is on no list
and is allowed. Repeated rows are judged each; nulls and repeats in the list are ignored. Of rules of equal
length the one with the longer host wins, then the first by code point. An empty table of pages gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from tidemill.llm.common import lower_ascii

BITS_PER_URL = 16
PROBES = 6


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


def _rest(url: Column) -> Column:
    """What follows the first ``://``, or an empty string."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.lit(2**31 - 1))).otherwise("")


def host(url: Column) -> Column:
    return lower_ascii(F.coalesce(F.regexp_extract(_rest(url), r"^[^/?#]*", 0), F.lit("")))


def path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def canonical(url: Column) -> Column:
    """Host without www and default port, path without a closing slash, and the sorted parameters that do
    not merely track; no scheme, no fragment. Null without a host."""
    bare = F.regexp_replace(F.regexp_replace(host(url), r"^www\.", ""), r":(80|443)$", "")
    query = F.regexp_extract(_rest(url), r"^[^?#]*\?([^#]*)", 1)
    kept = F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.rlike(r"^(utm_[a-z]+|ref|gclid|fbclid)(=|$)"))
    tail = F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(F.array_sort(kept), "&"))).otherwise("")
    return F.when(bare != "", F.concat(bare, F.regexp_replace(path(url), r"/+$", ""), tail))


def rule_of(rules: list[Rule], at: Column, route: Column) -> Column:
    """The longest rule that fits, as struct(rule, verdict); null if none does."""
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    order = sorted(rules, key=lambda r: (-len(r.name), -len(r.host), r.host))
    for r in reversed(order):
        fits = ((at == r.host) | at.endswith("." + r.host)) & route.startswith(r.path)
        found = F.when(fits, F.struct(F.lit(r.name).alias("rule"), F.lit(r.verdict).alias("verdict"))).otherwise(found)
    return found


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks))


def _bits(key: Column) -> Column:
    """``PROBES`` bits of a 64-bit word, six bits of a second hash for each."""
    h, bits = F.xxhash64(key, F.lit(77)), F.lit(0).cast("long")
    for i in range(PROBES):
        place = F.shiftrightunsigned(h, 6 * i).bitwiseAND(F.lit(63)).cast("int")
        bits = bits.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), place))
    return bits


def blocked_bloom(listed: DataFrame, key: str, blocks: int) -> DataFrame:
    """block, word: the filter of the listed keys. Combined on the map side, so a hot block is no burden."""
    return listed.groupBy(_block(F.col(key), blocks).alias("block")).agg(
        F.bit_or(_bits(F.col(key))).alias("word"))


def blocks_for(n: int) -> int:
    return max(1, -(-n * BITS_PER_URL // 64))


def judge(pages: DataFrame, listed: DataFrame, rules: list[Rule]) -> DataFrame:
    """page_id, host, path, rule, verdict for every row of ``pages`` (page_id, url).

    ``listed`` has a column ``canonical``; its URLs are blocked where no rule decides.
    """
    urls = listed.select("canonical").where("canonical is not null").distinct()
    blocks = blocks_for(urls.count())
    bloom = blocked_bloom(urls, "canonical", blocks)
    url = F.col("url")
    parsed = pages.select("page_id", host(url).alias("host"), path(url).alias("path"), canonical(url).alias("canonical"))
    ruled = parsed.withColumn("found", rule_of(rules, F.col("host"), F.col("path")))

    decided = ruled.where("found is not null").select(
        "page_id", "host", "path", "found.rule", "found.verdict")
    open_ = ruled.where("found is null").drop("found")
    probed = open_.withColumns({"block": _block(F.col("canonical"), blocks), "bits": _bits(F.col("canonical"))})
    # without a canonical form the block is that of a null; the row is then told apart by the null itself
    tested = probed.join(bloom, "block", "left").withColumn("possible", F.coalesce(
        F.col("canonical").isNotNull() & (F.col("word").bitwiseAND(F.col("bits")) == F.col("bits")), F.lit(False)))
    exact = urls.withColumn("listed", F.lit(True))
    hit = tested.where("possible").join(exact, "canonical", "left")
    no_rule = F.lit(None).cast("string").alias("rule")
    checked = hit.select("page_id", "host", "path", no_rule, F.when(F.col("listed"), "block").otherwise("allow").alias("verdict"))
    missed = tested.where("not possible").select("page_id", "host", "path", no_rule, F.lit("allow").alias("verdict"))
    return decided.unionByName(checked).unionByName(missed)
