"""Exact top-k search by inner product in M-trees (operator 3).

Vectors are made integer and dealt over trees of bounded size. With one more
component that brings every vector of a tree to the same norm, the largest inner
products with a query are the smallest distances to it, so a metric tree finds
them. Pages hold pivots with covering radii and the distance of each entry to
the page's own pivot. The search is best first; before a distance is computed,
the stored one and the query's distance to the pivot bound it by the triangle
inequality, and entries beyond the k-th best so far are passed over. Distances
only choose what to look at, with room for rounding; scores are integer.

Every query meets every tree, in blocks: a task has one tree and one block of
queries, and gives ``k`` rows per query. Nothing is broadcast.

Defined results: vectors that are NULL or hold NULL or non-finite components
take no part; vectors of different length have no score; ties go to the smaller
id; a repeated row is a candidate, and as a query a query, of its own; an empty
table gives an empty result. Components are taken to fit 32 bits once integer.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from txrisk.llm.common import stored

PAGE = 48
FANOUT = 24
# Relative room for rounding in distances.
SLACK = 1e-9


class Node:
    """A page of the tree. A leaf has ``rows``, an inner page ``children``;
    ``to_parent`` are their distances to this page's pivot."""

    __slots__ = ("pivot", "radius", "children", "rows", "to_parent", "pivots", "radii")

    def __init__(self, pivot: np.ndarray) -> None:
        self.pivot, self.radius = pivot, 0.0
        self.children: list[Node] = []
        self.rows: np.ndarray | None = None


def _distances(points: np.ndarray, point: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(((points - point) ** 2).sum(axis=1), 0))


def build(points: np.ndarray, rows: np.ndarray, pivot: np.ndarray) -> Node:
    """Bulk load: pivots drawn evenly from the rows, each row to its nearest.
    Rows that no pivot tells apart are cut into pages as they come."""
    node = Node(pivot)
    mine = points[rows]
    node.to_parent = _distances(mine, pivot)
    node.radius = float(node.to_parent.max(initial=0.0))
    if len(rows) <= PAGE:
        node.rows = rows
        return node
    chosen = mine[np.linspace(0, len(rows) - 1, FANOUT).astype(int)]
    squares = (mine**2).sum(axis=1)[:, None] - 2 * mine @ chosen.T + (chosen**2).sum(axis=1)
    nearest = squares.argmin(axis=1)
    parts = [(rows[nearest == k], chosen[k]) for k in range(FANOUT)]
    parts = [(part, at) for part, at in parts if len(part)]
    if len(parts) == 1:
        parts = [(part, part_pivot) for part in np.array_split(rows, FANOUT) for part_pivot in [points[part[0]]]]
    node.children = [build(points, part, at) for part, at in parts]
    node.pivots = np.stack([c.pivot for c in node.children])
    node.radii = np.array([c.radius for c in node.children])
    node.to_parent = _distances(node.pivots, pivot)
    return node


class MTree:
    def __init__(self, ids: np.ndarray, uids: np.ndarray, vectors: np.ndarray) -> None:
        self.ids, self.uids, self.vectors = ids, uids, vectors
        floats = vectors.astype(np.float64)
        norms = (floats**2).sum(axis=1)
        self.norm = float(norms.max(initial=0.0))
        lift = np.sqrt(np.maximum(self.norm - norms, 0))[:, None]
        self.root = build(np.hstack([floats, lift]), np.arange(len(ids)), np.append(floats[0], lift[0]))

    def top(self, uid: int, query: np.ndarray, k: int) -> list[tuple[int, int]]:
        """The ``k`` best (score, id) of rows other than ``uid``."""
        point = np.append(query.astype(np.float64), 0.0)
        most = float(point @ point) + self.norm
        room = SLACK * (most + 1)
        best: list[tuple[int, int, int]] = []  # worst first: (score, -id, row)
        limit = np.inf  # squared distance beyond which nothing can enter
        start = float(_distances(self.root.pivot[None], point)[0])
        heap: list[tuple[float, int, float, Node]] = [(0.0, 0, start, self.root)]
        pushed = 0
        while heap:
            least, _, to_pivot, node = heapq.heappop(heap)
            if least**2 > limit:
                break
            reach = np.sqrt(limit) if limit < np.inf else np.inf
            if node.rows is None:
                near = np.abs(to_pivot - node.to_parent) - node.radii <= reach
                if not near.any():
                    continue
                at = np.flatnonzero(near)
                distance = _distances(node.pivots[at], point)
                for child, d in zip(at.tolist(), distance.tolist()):
                    lower = max(least, d - node.children[child].radius)
                    if lower**2 <= limit:
                        pushed += 1
                        heapq.heappush(heap, (lower, pushed, d, node.children[child]))
                continue
            rows = node.rows[np.abs(to_pivot - node.to_parent) <= reach]
            scores = self.vectors[rows] @ query
            for row, score in zip(rows.tolist(), scores.tolist()):
                if self.uids[row] == uid:
                    continue
                entry = (score, -int(self.ids[row]), row)
                if len(best) < k:
                    heapq.heappush(best, entry)
                elif entry > best[0]:
                    heapq.heapreplace(best, entry)
            if len(best) == k:
                # distance² = |q|² + norm - 2 * score
                limit = most - 2 * best[0][0] + room
        return [(score, -negative) for score, negative, _ in best]


def integer_vectors(rows: DataFrame, scale: int) -> DataFrame:
    """vec_id and the components as integers, of vectors that take part."""
    x = F.col("embedding")
    good = x.isNotNull() & ~F.exists(
        x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf"))
    )
    whole = F.transform(x, lambda c: F.floor(F.lit(float(scale)) * c.cast("double")).cast("bigint"))
    return rows.filter(F.coalesce(good, F.lit(False))).select("vec_id", whole.alias("vector"))


def search(
    rows: DataFrame,
    is_query,
    k: int = 10,
    scale: int = 1024,
    tree_rows: int = 16_384,
    block: int = 16_384,
) -> DataFrame:
    """query_id, rank, vec_id and score: the ``k`` best rows for each row where
    the Column ``is_query`` holds."""
    vectors = stored(
        integer_vectors(rows, scale)
        .withColumn("uid", F.monotonically_increasing_id())
        .withColumn("query", F.coalesce(is_query, F.lit(False))),
        "vectors",
    )
    total, asked = vectors.agg(
        F.count(F.lit(1)), F.coalesce(F.sum(F.col("query").cast("int")), F.lit(0))
    ).first()
    trees, blocks = max(1, -(-total // tree_rows)), max(1, -(-asked // block))
    size = F.size("vector").alias("size")
    mixed = F.xxhash64("uid")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    candidates = vectors.select(
        size, F.pmod(mixed, F.lit(trees)).cast("int").alias("tree"), every(blocks).alias("block"),
        "uid", "vec_id", "vector",
    )
    # Columns of its own: with those of the other side, Spark would take a
    # column that one side does not need from both.
    queries = vectors.filter("query").select(
        size.alias("q_size"), every(trees).alias("q_tree"),
        F.pmod(mixed, F.lit(blocks)).cast("int").alias("q_block"),
        F.col("uid").alias("q_uid"), F.col("vec_id").alias("query_id"),
        F.col("vector").alias("query_vector"),
    )
    kind = rows.schema["vec_id"].dataType.simpleString()

    asked_columns = ["q_uid", "query_id", "query_vector"]

    def find(queries: pd.DataFrame, candidates: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(queries) and len(candidates):
            tree = MTree(
                candidates["vec_id"].to_numpy(),
                candidates["uid"].to_numpy(),
                np.stack(candidates["vector"].to_list()).astype(np.int64),
            )
            for uid, query_id, vector in zip(*(queries[c] for c in asked_columns)):
                query = np.asarray(vector, dtype=np.int64)
                found += [(uid, query_id, i, score) for score, i in tree.top(uid, query, k)]
        return pd.DataFrame(found, columns=["uid", "query_id", "vec_id", "score"])

    found = (
        queries.groupBy("q_size", "q_tree", "q_block")
        .cogroup(candidates.groupBy("size", "tree", "block"))
        .applyInPandas(find, f"uid bigint, query_id {kind}, vec_id {kind}, score bigint")
    )
    order = Window.partitionBy("uid").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
