"""MinHash near-dedup by bottom-k sketches from one hash function.

1. Every text becomes its set of hashed word shingles. Equal sets are one node from here on.
2. The ``K`` smallest hashes of a set are its sketch. Two sets that are similar enough share ``need`` of them, so they
   meet in the inverted list of one of the ``size - need + 1`` rarest values of either sketch; only those lists are
   used, which leaves out words that very many texts have.
3. Lists are worked off in rounds, since only components are asked for. The most central member of a list meets all
   others, then a few members of its largest component do; members that are in one component by then need no
   further test. Where few members are left outside the largest component, they meet all others.
4. A list with more of them is split by further values that its members share: the lists of their full sets take its
   place, by the same rule of rare values. There, the rank of a value in a set also tells the largest overlap that is left, so
   members without a partner drop out, such as copies too far from the others or texts around a common passage.
5. Pairs pass an estimate from the sketch of their union, then the exact Jaccard similarity of their full sets.

Two texts are linked when 100 * intersection >= percent * union. No list and no number of partners is
capped. Sketches miss a pair at the threshold with a probability of about 1e-5.

Defined results: a text that is null, empty or without words has an empty set and stands alone; a text with
fewer words than a shingle is one shingle. Repeated rows fall into one component. ``component_id`` is the
smallest doc_id of a component; rows without doc_id count as members but never as the smallest, and are
kept only where no row of the component has an id. Other columns are ignored. An empty table gives an
empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemill.llm.common import mix64, small_batches, stored
from tidemill.llm.components import labels, shortened
from tidemill.llm.shingles import shingle_sets

WORDS = 5
PERCENT = 80
K = 32
#: Flips the sign bit: sketches keep, as signed longs, the unsigned order in which their values are the smallest.
_SIGN = np.uint64(1 << 63)
#: The chance that the sketches of two sets at the threshold share fewer values than are asked for.
MISS = 1e-5
SALTS = 16
#: Rounds in which so many members of a list's largest component meet the others, before the others meet all.
PROBES = 1
PROBE_HUBS = 8
#: A list of sketches with more members than this outside its largest component is split by the values of full sets.
FEW = 8
#: Pairs that a list may add in its second round, doubled in each later one.
ROUND_PAIRS = 1 << 20


def shared_least(percent: int) -> int:
    """Values that two whole sketches of sets at ``percent`` share, but for a chance of ``MISS``."""
    p, below, least = percent / 100, 0.0, 0
    while least < K:
        below += comb(K, least) * p**least * (1 - p) ** (K - least)
        if below > MISS:
            break
        least += 1
    return max(1, least)


def _node(values: np.ndarray) -> int:
    """64 bits that name a set."""
    return int(mix64(np.array([values.sum(dtype=np.uint64) ^ mix64(values ^ np.uint64(len(values) + 1)).sum(
        dtype=np.uint64)], dtype=np.uint64)).view(np.int64)[0])


def _sketches(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes, counts, sketches = [], [], []
            for values in shingle_sets(batch.column(1).to_pylist(), size):
                nodes.append(_node(values))
                counts.append(len(values))
                sketches.append((values[:K] ^ _SIGN).view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(nodes, pa.int64()), pa.array(counts, pa.int64()),
                 pa.array(sketches, pa.list_(pa.int64()))], names=["doc_id", "text_hash", "node", "n_shingles", "sketch"])
    return run


def _full_sets(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes, sets = [], []
            for values in shingle_sets(batch.column(0).to_pylist(), size):
                nodes.append(_node(values))
                sets.append(values.tobytes())
            yield pa.RecordBatch.from_arrays(
                [pa.array(nodes, pa.int64()), pa.array(sets, pa.binary())], names=["node", "values"])
    return run


def _verify(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            linked = []
            for a, b in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                x, y = np.frombuffer(a, dtype=np.uint64), np.frombuffer(b, dtype=np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                linked.append(100 * both >= percent * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(linked, pa.bool_())], names=["a", "b", "linked"])
    return run


def sketched(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """doc_id, text_hash, node, n_shingles, sketch for every row of ``docs`` (doc_id, text)."""
    small_batches(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long"), "text", F.xxhash64("text")).mapInArrow(
        _sketches(words), "doc_id long, text_hash long, node long, n_shingles long, sketch array<long>")


def _exploded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The values of one set after the other, as rows."""
    for batch in batches:
        for node, size, values in zip(*(c.to_pylist() for c in batch.columns)):
            rows = np.frombuffer(values, dtype=np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(rows), node)), pa.array(np.full(len(rows), size)), pa.array(rows)],
                names=["node", "n_shingles", "value"])


def sketch_lists(nodes: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The inverted lists of the sketches in ``nodes`` (node, n_shingles, sketch) in which similar nodes meet."""
    size, least = F.col("n_shingles"), shared_least(percent)
    # of a set that is its own sketch, a larger partner's sketch leaves out no more than the partner has over K
    left_out = F.greatest(F.lit(least), F.floor(K - size * (100 - percent) / percent))
    need = F.when(size <= K, F.least(F.ceil(size * percent / 100), left_out)).otherwise(least).cast("int")
    postings = nodes.select("node", "n_shingles", need.alias("need"), F.explode("sketch").alias("value"))
    return _rare(postings, percent, F.floor(size * 100 / percent))


def whole_lists(sets: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The inverted lists of the full ``sets`` (node, n_shingles, values) in which similar nodes meet."""
    size = F.col("n_shingles")
    rows = sets.select("node", "n_shingles", "values").mapInArrow(_exploded, "node long, n_shingles long, value long")
    postings = rows.withColumn("need", F.ceil(size * percent / 100).cast("int"))
    by_rest = F.floor(F.col("rest") * (100 + percent) / percent) - size
    return _rare(postings, percent, F.least(F.floor(size * 100 / percent), by_rest))


def _rare(postings: DataFrame, percent: int, most: Column) -> DataFrame:
    """value, node, n_shingles, most, length: the lists of the rarest values of each node; equal lists are kept once.

    ``most`` is the largest size of a partner whose first common value, in the order of rarity, is that of the list: the
    values before it are not shared, which leaves ``rest`` for the overlap. A list is split by the classes of size in
    which partners can be. Members that are too large, or have too little left, for all the others drop out.
    """
    size = F.col("n_shingles")
    shared = stored(postings.groupBy("value").agg(F.count("*").alias("df")).where("df > 1"), "values")
    common = postings.join(shared, "value")
    own = Window.partitionBy("node")
    # values that no other node has come first in the order
    ranked = common.withColumn("rest", F.count("*").over(own) + 1 - F.row_number().over(own.orderBy("df", "value")))
    reach = ranked.where("rest >= need").select("value", "df", "node", "n_shingles", most.alias("most"))
    home, last = _size_class(size, percent), _size_class(F.greatest("most", "n_shingles"), percent)
    lists = stored(reach.withColumn("home", home).withColumn("class", F.explode(F.sequence(home, last))).select(
        F.xxhash64("value", "class").alias("value"), "df", F.col("value").alias("of"), "node", "n_shingles", "most",
        (F.col("class") == F.col("home")).alias("at_home")), "lists")
    # of a pair, the smaller one must have room for a partner of its own size
    small = lists.where(F.col("most") >= size).groupBy("value").agg(F.min("n_shingles").alias("smallest"))
    alive = lists.join(small, "value").where(F.col("most") >= F.col("smallest"))
    named = alive.groupBy("value", "df", "of").agg(
        F.count("*").alias("length"), F.bit_xor(F.xxhash64("node")).alias("members"),
        F.max("at_home").alias("at_home")).where("length > 1 and at_home")
    # of equal lists the one of the rarest value has the first common value of all its pairs
    once = named.groupBy("length", "members").agg(F.min(F.struct("df", "of", "value")).alias("first"))
    kept = once.select(F.col("first.value").alias("value"), "length")
    return stored(alive.join(kept, "value").select("value", "node", "n_shingles", "most", "length"), "lists-once")


def _size_class(size: Column, percent: int) -> Column:
    """Sizes of one class, or of two that follow each other, are all that similar sets can have."""
    return F.floor(F.log(size.cast("double")) / F.log(F.lit(100 / percent)) if percent < 100 else size)


def _estimated(pairs: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    """a, b, likely: whether the sketch of a pair's union allows the similarity."""
    left = sketches.select(F.col("node").alias("a"), F.col("n_shingles").alias("n"), F.col("sketch").alias("x"))
    right = sketches.select(F.col("node").alias("b"), F.col("n_shingles").alias("m"), F.col("sketch").alias("y"))
    both = pairs.join(left, "a").join(right, "b")
    whole = (F.col("n") <= K) & (F.col("m") <= K)
    exact = F.size(F.array_intersect("x", "y")) * 100 >= F.size(F.array_union("x", "y")) * percent
    union = F.slice(F.array_sort(F.array_union("x", "y")), 1, K)
    likely = F.size(F.array_intersect(F.array_intersect("x", "y"), union)) >= shared_least(percent)
    return both.select("a", "b", F.when(whole, exact).otherwise(likely).alias("likely"))


def full_sets(docs: DataFrame, nodes: DataFrame, words: int) -> DataFrame:
    """node, n_shingles, values: the full set of each of ``nodes`` (node, n_shingles, least), from the text of ``least``."""
    asked = nodes.select(F.col("least").alias("asked")).distinct()
    texts = docs.select(F.col("doc_id").cast("long"), "text").join(
        asked, F.col("doc_id").eqNullSafe(F.col("asked")), "left_semi")
    sets = texts.select("text").mapInArrow(_full_sets(words), "node long, values binary")
    return stored(sets.join(nodes.select("node", "n_shingles"), "node").dropDuplicates(["node"]), "sets")


def _linked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs that the full sets confirm."""
    sided = pairs.join(sets.select(F.col("node").alias("a"), F.col("values").alias("x")), "a").join(
        sets.select(F.col("node").alias("b"), F.col("values").alias("y")), "b")
    checked = sided.select("a", "b", "x", "y").mapInArrow(_verify(percent), "a long, b long, linked boolean")
    return checked.where("linked").select("a", "b")


def _meet(hubs: DataFrame, lists: DataFrame) -> DataFrame:
    """Pairs of the hubs of a list and its members of other components whose sizes and ranks allow the similarity."""
    met = hubs.select("value", F.col("node").alias("hub"), F.col("root").alias("hub_root"), F.col("n_shingles").alias(
        "hub_size"), F.col("most").alias("hub_most")).join(lists, "value")
    alike = (F.col("n_shingles") <= F.col("hub_most")) & (F.col("hub_size") <= F.col("most"))
    return met.where((F.col("root") != F.col("hub_root")) & alike).select(
        F.least("hub", "node").alias("a"), F.greatest("hub", "node").alias("b"))


def _rooted(lists: DataFrame, stars: DataFrame | None) -> DataFrame:
    """The list members with the component that they are in so far."""
    if stars is None:
        return lists.withColumn("root", F.col("node"))
    return lists.join(labels(stars), "node", "left").withColumn("root", F.coalesce("root", "node"))


class _Found:
    """Links found so far, as stars, and the pairs that were tested for them."""

    def __init__(self, sketches: DataFrame, sets: DataFrame, percent: int):
        self.sketches, self.sets, self.percent = sketches, sets, percent
        self.tested = self.stars = None

    def test(self, pairs: DataFrame) -> None:
        pairs = pairs.distinct()
        if self.tested is not None:
            pairs = pairs.join(self.tested, ["a", "b"], "left_anti")
        pairs = stored(_estimated(pairs, self.sketches, self.percent), "pairs")
        met = pairs.select("a", "b")
        self.tested = met if self.tested is None else self.tested.unionByName(met)
        new = stored(_linked(pairs.where("likely").select("a", "b"), self.sets, self.percent), "linked")
        new = new.select(F.col("a").alias("u"), F.col("b").alias("v"))
        if new.isEmpty():  # what was found before are stars already
            self.stars = new if self.stars is None else self.stars
        else:
            self.stars = shortened(new if self.stars is None else self.stars.unionByName(new))


def _worked_off(lists: DataFrame, found: _Found, few: int | None = None) -> DataFrame | None:
    """Test the pairs of ``lists`` in rounds; with ``few``, give back the members of lists with more outsiders."""
    central = lists.groupBy("node").agg(F.sum("length").alias("central"))
    lists = stored(lists.join(central, "node"), "central")
    settled = None
    turn = 0
    while True:
        rooted = _rooted(lists, found.stars)
        if found.stars is not None:
            rooted = stored(rooted, "rooted")
        open_ = rooted if settled is None else rooted.join(settled, ["value", "node"], "left_anti")
        # a list is finished when the members that have not met all others are of one component
        left = open_.groupBy("value").agg(
            F.min("root").alias("low"), F.max("root").alias("high")).where("low < high").select("value")
        open_ = stored(open_.join(left, "value", "left_semi"), "open")
        if open_.isEmpty():
            return None
        members = rooted.join(open_.select("value").distinct(), "value", "left_semi")
        # the component with most open members waits: the others meet it
        weight = open_.groupBy("value", "root").agg(F.count("*").alias("n"))
        main = weight.groupBy("value").agg(
            F.max(F.struct("n", "root")).alias("top"), F.sum("n").alias("all")).select(
            "value", F.col("top.root").alias("main"), (F.col("all") - F.col("top.n")).alias("outside"))
        order = Window.partitionBy("value").orderBy(F.col("central").desc(), "node")
        if turn == 0:
            hubs = open_.withColumn("rank", F.row_number().over(order)).where("rank = 1")
        elif turn <= PROBES:
            # some members of the largest component, others in every round, take in most of its near copies
            chance = Window.partitionBy("value").orderBy(F.xxhash64("node", F.lit(turn)), "node")
            inner = open_.join(main, "value").where("root = main")
            hubs = inner.withColumn("rank", F.row_number().over(chance)).where(F.col("rank") <= PROBE_HUBS)
        elif few is not None:
            hubs = open_.join(main.where(F.col("outside") <= few), "value").where("root <> main")
        else:
            rest = open_.join(main, "value").where("root <> main")
            most = F.greatest(F.lit(4), F.lit(ROUND_PAIRS) / F.col("length")) * float(1 << turn)
            hubs = rest.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)
        hubs = stored(hubs.select("value", "node", "root", "n_shingles", "most"), "hubs")
        found.test(_meet(hubs, members))
        if few is not None and turn > PROBES:
            return stored(members.join(main.where(F.col("outside") > few), "value", "left_semi").select(
                "node").distinct(), "long")
        done = hubs.select("value", "node")
        settled = done if settled is None else settled.unionByName(done)
        lists = members.drop("root")  # what is finished stays so
        turn += 1


def links(docs: DataFrame, nodes: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """u, v: links of which the components are those of all similar pairs.

    ``nodes`` has node, n_shingles, sketch and ``least``, the doc_id of a row of each node.
    """
    lists = sketch_lists(nodes, percent)
    # the texts of all nodes that may have a partner are read once
    sets = full_sets(docs, nodes.join(lists.select("node").distinct(), "node").select("node", "n_shingles", "least"), words)
    found = _Found(nodes.select("node", "n_shingles", "sketch"), sets.select("node", "values"), percent)
    crowded = _worked_off(lists, found, FEW)
    if crowded is not None and not crowded.isEmpty():
        _worked_off(whole_lists(sets.join(crowded, "node", "left_semi"), percent), found)
    return found.stars if found.stars is not None else lists.select(
        F.col("node").alias("u"), F.col("node").alias("v")).limit(0)


def members(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """doc_id, text_hash, n_shingles, root, component_id for every row of ``docs`` (doc_id, text).

    ``root`` names the component, also where no row of it has an id; it is null for rows that stand alone without words.
    """
    rows = stored(sketched(docs, words), "sketches")
    full = rows.where("n_shingles > 0")
    # copies are combined before the shuffle, so a large group of them is no burden
    nodes = stored(full.groupBy("node").agg(
        F.min("doc_id").alias("least"), F.max("n_shingles").alias("n_shingles"), F.first("sketch").alias("sketch")), "nodes")
    found = links(docs, nodes, words, percent)
    roots = stored(labels(found), "roots")
    rooted = nodes.select("node", "least").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    smallest = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = rooted.join(smallest, "root").select("node", "root", "component_id")
    salted = named.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    own = full.withColumn("salt", F.pmod(F.xxhash64("doc_id", "text_hash"), F.lit(SALTS)).cast("int"))
    joined = own.join(salted, ["node", "salt"]).select("doc_id", "text_hash", "n_shingles", "root", "component_id")
    alone = rows.where("n_shingles = 0").select(
        "doc_id", "text_hash", "n_shingles", F.lit(None).cast("long").alias("root"), F.col("doc_id").alias("component_id"))
    return joined.unionByName(alone)


def near_duplicates(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row of ``docs`` (doc_id, text)."""
    kept = F.coalesce(F.col("doc_id") == F.col("component_id"), F.col("component_id").isNull())
    return members(docs, words, percent).select("doc_id", "n_shingles", "component_id", kept.alias("kept"))


def one_each(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs``, with all columns, of which one is left of each component.

    That is the one with the smallest doc_id; rows without id come last, and among rows of one id the text decides by its
    hash. Rows without words all stay. Rows that are equal in doc_id and text are one.
    """
    # read twice below
    rows = stored(members(docs, words, percent), "members")
    first = rows.where(F.col("root").isNotNull()).groupBy("root").agg(F.min(F.struct(
        F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash")).alias("first")).select("first.doc_id", "first.text_hash")
    alone = rows.where(F.col("root").isNull()).select("doc_id", "text_hash")
    left = first.unionByName(alone).distinct().toDF("_id", "_hash")
    same = docs["doc_id"].cast("long").eqNullSafe(left["_id"]) & (F.xxhash64(docs["text"]) == left["_hash"])
    return docs.join(left, same, "left_semi").dropDuplicates(["doc_id", "text"])
