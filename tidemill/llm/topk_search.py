"""Exact top-k search by inner product with a dual-tree traversal of cover trees.

Queries and candidates are dealt into blocks; each pair of blocks meets in one task, which indexes both
sides with a cover tree and walks the two trees together. A pair of nodes is left out when the best score
that its covering radii allow is below the worst kth score of the query node; a pair of leaves is one matrix product. Every task returns k rows a
query, and the best k of those are the answer: nothing is approximate.

Components are floor(256 * x); scores are exact integers. Vectors that are null, or that hold a null or a
non-finite component, take no part, nor do rows without vec_id; vectors of different length don't meet.
Repeated rows (same id, same vector) count once; ties go to the smaller vec_id. A query with fewer
candidates than k gets all of them. Empty tables give an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemill.llm.common import parts_for

SCALE = 256
DATA_BLOCK = 8192
QUERY_BLOCK = 8192
#: Rows of a leaf of data and of queries, children of a node, and rows among which the centres of the children are chosen.
LEAF = 256
QUERY_LEAF = 16
FANOUT = 16
TRIED = 256
#: Beyond this a component's products leave the range in which doubles are exact.
LIMIT = 1 << 22


@dataclass
class Node:
    start: int
    stop: int
    centre: np.ndarray
    norm: float
    radius: float
    children: list


def _squares(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distances of all points from all centres."""
    away = (points ** 2).sum(axis=1)[:, None] - 2 * (points @ centres.T) + (centres ** 2).sum(axis=1)
    return np.maximum(away, 0)


class CoverTree:
    """Nested nodes over ``points``: a node's points lie within its radius of its centre, which is one of them.

    The centres of the children are the node's own and others chosen farthest first, so they are further apart than any
    tried point is from the nearest of them; every point goes to the nearest. There are ``FANOUT`` at most, as in many
    dimensions almost all points are far from each other. ``order`` lists the rows so that every node is a slice.
    """

    def __init__(self, points: np.ndarray, leaf: int = LEAF):
        self.points, self.leaf = points, leaf
        order: list[np.ndarray] = []
        self.size = 0
        self.root = self._node(np.arange(len(points)), 0, order) if len(points) else None
        self.order = np.concatenate(order) if order else np.zeros(0, dtype=np.int64)
        self.sorted = points[self.order]

    def _node(self, rows: np.ndarray, centre: int, order: list) -> Node:
        own, point = self.points[rows], self.points[centre]
        radius = float(np.sqrt(_squares(own, point[None])).max())
        node = Node(self.size, 0, point, float(np.linalg.norm(point)), radius, [])
        if len(rows) <= self.leaf or radius == 0.0:
            order.append(rows)
            self.size += len(rows)
        else:
            centres = self._centres(rows, centre)
            nearest = _squares(own, self.points[centres]).argmin(axis=1)
            for i, head in enumerate(centres):
                node.children.append(self._node(rows[nearest == i], head, order))
        node.stop = self.size
        return node

    def _centres(self, rows: np.ndarray, centre: int) -> list[int]:
        tried = rows[:: max(1, len(rows) // TRIED)]
        if (self.points[tried] == self.points[centre]).all():  # the others were not among those tried
            tried = rows[(self.points[rows] != self.points[centre]).any(axis=1)][:TRIED]
        points, centres = self.points[tried], [centre]
        near = _squares(points, self.points[[centre]])[:, 0]
        while len(centres) < FANOUT and near.max() > 0:
            centres.append(int(tried[near.argmax()]))
            near = np.minimum(near, _squares(points, self.points[centres[-1:]])[:, 0])
        return centres


def _search(query: np.ndarray, query_id: np.ndarray, data: np.ndarray, data_id: np.ndarray, k: int):
    """For each query its k best (score, id), worse ones first, missing ones with score -inf; and the products made."""
    queries, index = CoverTree(query, QUERY_LEAF), CoverTree(data)
    q, d = queries.sorted, index.sorted
    q_id, d_id = query_id[queries.order], data_id[index.order]
    score = np.full((len(q), k), -np.inf)
    found = np.full((len(q), k), np.iinfo(np.int64).max)
    products = 0

    def bound(a: Node, b: Node) -> float:
        best = a.centre @ b.centre + a.radius * b.norm + b.radius * a.norm + a.radius * b.radius
        return best + 1e-9 * (abs(best) + 1.0)

    def compare(a: Node, b: Node) -> None:
        nonlocal products
        rows = np.arange(b.start, b.stop)
        if b.radius == 0.0 and len(rows) > k + 1:  # equal vectors: only the smallest ids can count
            rows = rows[np.argsort(d_id[rows], kind="stable")[: k + 1]]
        product = q[a.start:a.stop] @ d[rows].T
        products += product.size
        product[q_id[a.start:a.stop, None] == d_id[rows][None, :]] = -np.inf
        at = a.start + np.flatnonzero(product.max(axis=1) >= score[a.start:a.stop, 0])
        if len(at):
            s = np.concatenate([score[at], product[at - a.start]], axis=1)
            n = np.concatenate([found[at], np.broadcast_to(d_id[rows], (len(at), len(rows)))], axis=1)
            best = np.lexsort((-n, s), axis=1)[:, -k:]
            score[at], found[at] = np.take_along_axis(s, best, 1), np.take_along_axis(n, best, 1)

    def reaches(a: Node, b: Node) -> bool:
        return bound(a, b) >= score[a.start:a.stop, 0].min()

    def walk(a: Node, b: Node) -> None:
        if not reaches(a, b):
            return
        # a group of queries stays together as long as none of its parts can be left out
        live = [child for child in a.children if reaches(child, b)]
        if len(live) < len(a.children):
            for child in live:
                walk(child, b)
        elif b.children:
            for child in sorted(b.children, key=lambda c: -bound(a, c)):
                walk(a, child)
        else:
            compare(a, b)

    if len(q) and len(d):
        walk(queries.root, index.root)
    return q_id, score, found, products


_RESULT = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])


def _matrix(table: pa.Table) -> np.ndarray:
    return np.array(table["v"].to_pylist(), dtype=np.float64)


def _block_pair(k: int):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out: list[tuple[np.ndarray, ...]] = []
        if left.num_rows and right.num_rows:
            q_id, score, found, _ = _search(
                _matrix(left), left["id"].to_numpy(), _matrix(right), right["id"].to_numpy(), k)
            rows, cols = np.nonzero(np.isfinite(score))
            out = [q_id[rows], found[rows, cols], score[rows, cols].astype(np.int64)]
        else:
            out = [np.zeros(0, dtype=np.int64)] * 3
        return pa.table(out, schema=_RESULT)
    return run


def quantised(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """id, v, dim of the rows that take part, each once."""
    x = F.col(embedding)
    whole = F.transform(x, lambda c: F.floor(c.cast("double") * SCALE).cast("double"))
    usable = F.col(vec_id).isNotNull() & x.isNotNull() & ~F.exists(
        x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    rows = vectors.where(F.coalesce(usable, F.lit(False))).select(
        F.col(vec_id).alias("id"), whole.alias("v"), F.size(x).alias("dim"))
    too_large = F.exists("v", lambda c: F.abs(c) > LIMIT)
    safe = F.when(too_large, F.raise_error(F.lit("a component is too large for exact scores"))).otherwise(F.col("v"))
    return rows.withColumn("v", safe.cast("array<double>")).distinct()


def top_k(vectors: DataFrame, is_query: Column, k: int = 5) -> DataFrame:
    """query_id, rank, vec_id, score: for the rows with ``is_query`` (on ``id``) the k best others."""
    rows = quantised(vectors)
    n, n_query = rows.agg(F.count("*"), F.count(F.when(is_query, 1))).first()
    data_blocks, query_blocks = parts_for(n, DATA_BLOCK), parts_for(n_query, QUERY_BLOCK)

    def dealt(side: DataFrame, own: str, blocks: int, other: str, others: int) -> DataFrame:
        return side.withColumn(own, F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("long")).withColumn(
            other, F.explode(F.sequence(F.lit(0), F.lit(others - 1)).cast("array<long>")))

    queries = dealt(rows.where(is_query), "q_block", query_blocks, "d_block", data_blocks)
    data = dealt(rows, "d_block", data_blocks, "q_block", query_blocks)
    pair = ["dim", "q_block", "d_block"]
    best = queries.groupBy(*pair).cogroup(data.groupBy(*pair)).applyInArrow(
        _block_pair(k), "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")
