"""Nearest neighbours by inner product: a hierarchical k-means tree searched best bin first."""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.lookup import lookup_join
from tidemark.session import staged

# Vectors that the tree is fitted on, its branching, and the part of the sample that a leaf has
# at most (but at least so many vectors): the number of leaves is the same at every size.
FIT_VECTORS = 16_384
BRANCHES = 8
LEAF_SHARE = 1 / 48
LEAF_VECTORS = 32
# Queries that the number of leaves is calibrated with, and the recall they must reach.
CALIBRATION = 128
TARGET_RECALL = 0.95
# Vectors and queries of a block that are compared together.
BLOCK_VECTORS = 2048
BLOCK_QUERIES = 1024


@dataclass
class Node:
    """A node with the centres of its children; a leaf has a number instead."""

    centres: np.ndarray | None = None
    children: list[Node] = field(default_factory=list)
    leaf: int = -1


@dataclass
class Tree:
    root: Node
    leaves: int
    norm: float  # the largest norm of all vectors

    def lifted(self, vectors: np.ndarray) -> np.ndarray:
        """One more coordinate that makes all norms equal: nearest then is the largest product."""
        rest = np.maximum(self.norm**2 - (vectors**2).sum(axis=1), 0.0)
        return np.concatenate([vectors, np.sqrt(rest)[:, None]], axis=1)

    def leaf_of(self, vectors: np.ndarray) -> np.ndarray:
        """The leaf of each vector, by the nearest centre at every level."""
        found = np.zeros(len(vectors), np.int64)
        waiting = [(self.root, np.arange(len(vectors)), self.lifted(vectors))]
        while waiting:
            node, rows, points = waiting.pop()
            if node.centres is None:
                found[rows] = node.leaf
                continue
            nearest = _nearest(points, node.centres)
            for k, child in enumerate(node.children):
                here = nearest == k
                if here.any():
                    waiting.append((child, rows[here], points[here]))
        return found

    def traverse(
        self, query: np.ndarray, visits: int, rows: np.ndarray | None = None, need: int = 0
    ) -> list[int]:
        """The first leaves met when the nearest branch not yet taken is always taken next.

        They are ``visits`` leaves, and as many more as it takes to hold ``need`` of ``rows``.
        """
        point = np.append(query, 0.0)
        queue: list[tuple[float, int, Node]] = [(0.0, 0, self.root)]
        pushed, met, held = 0, [], 0
        while queue and (len(met) < visits or held < need):
            _, _, node = heapq.heappop(queue)
            while node.centres is not None:
                far = ((node.centres - point) ** 2).sum(axis=1)
                order = np.argsort(far, kind="stable")
                for k in order[1:]:
                    pushed += 1
                    heapq.heappush(queue, (float(far[k]), pushed, node.children[k]))
                node = node.children[order[0]]
            met.append(node.leaf)
            held += int(rows[node.leaf]) if rows is not None else 0
        return met


def _nearest(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.argmin((centres**2).sum(axis=1) - 2 * points @ centres.T, axis=1)


def fit_tree(sample: np.ndarray, norm: float) -> Tree:
    """Split by k-means until a node has few sample vectors, or equal ones."""
    tree = Tree(Node(), 0, norm)
    rng = np.random.default_rng(7)
    most = max(LEAF_VECTORS, int(len(sample) * LEAF_SHARE))

    def grow(node: Node, points: np.ndarray) -> None:
        distinct = np.unique(points, axis=0) if len(points) else points
        if len(points) <= most or len(distinct) < 2:
            node.leaf = tree.leaves
            tree.leaves += 1
            return
        k = min(BRANCHES, len(distinct))
        centres = distinct[rng.choice(len(distinct), k, replace=False)]
        for _ in range(12):
            nearest = _nearest(points, centres)
            sums = np.zeros_like(centres)
            np.add.at(sums, nearest, points)
            n = np.bincount(nearest, minlength=k)
            centres = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], centres)
        nearest = _nearest(points, centres)
        used = np.flatnonzero(np.bincount(nearest, minlength=k))
        if len(used) < 2:
            node.leaf = tree.leaves
            tree.leaves += 1
            return
        node.centres = centres[used]
        for c in used:
            child = Node()
            node.children.append(child)
            grow(child, points[nearest == c])

    grow(tree.root, tree.lifted(sample) if len(sample) else np.zeros((0, 1)))
    return tree


def usable(vectors: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """``vec_id, vector`` of rows that take part: not null, not zero, all components finite."""
    values = F.col(vector).cast("array<double>")
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), values.alias("vector"))
    return rows.where(
        F.col("vec_id").isNotNull()
        & F.col("vector").isNotNull()
        & F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
        & F.exists("vector", lambda x: x != 0)
    )


def nearest_neighbours(
    vectors: DataFrame,
    is_query: Column,
    k: int = 20,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    target_recall: float = TARGET_RECALL,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` largest inner products for every query.

    Queries are the rows where ``is_query`` (on the column ``vec_id``) holds; a query's
    candidates are all other rows.  Rows that are null, zero, not finite or without id take no
    part, nor do rows whose length is not the most frequent one (of equally frequent ones the
    longest).  Rows with a repeated id count one by one, but never for queries with that id.
    Equal scores are ranked by id; other columns are ignored; without rows that take part (an
    empty table, say) or without queries there are no neighbours.

    The tree is fitted on at most ``FIT_VECTORS`` rows, the first by a hash of their ids, and
    every row is put into a leaf.  For ``CALIBRATION`` queries the true neighbours among all
    rows are found and the number of leaves to visit is widened until the leaves visited hold
    the wanted share of them; a query goes on from there until its leaves hold ``k`` candidates,
    so it has fewer only if there are fewer.  A leaf's vectors and the queries that visit it are compared in
    blocks of bounded size, so a leaf with very many rows or queries is spread over tasks.
    """
    rows = usable(vectors, vec_id, vector)
    lengths = rows.groupBy(F.size("vector").alias("d")).count()
    common = lengths.orderBy(F.desc("count"), F.desc("d")).first()
    empty = vectors.sparkSession.createDataFrame([], _FOUND)
    if common is None:
        return empty
    rows = staged(rows.where(F.size("vector") == common["d"]), "vectors")
    squares = F.aggregate("vector", F.lit(0.0), lambda a, x: a + x * x)
    norm = float(rows.agg(F.sqrt(F.max(squares))).first()[0])
    some = rows.where(F.pmod(F.xxhash64("vec_id"), F.lit(common["count"])) < 2 * FIT_VECTORS)
    picked = some.orderBy(F.xxhash64("vec_id"), "vec_id").limit(FIT_VECTORS).select("vector").toArrow()
    tree = fit_tree(_matrix(picked.column(0).combine_chunks()), norm)
    placed = staged(rows.mapInArrow(lambda b: _assign(b, tree), "vec_id long, vector array<double>, leaf long"), "leaves")
    queries = placed.where(is_query)
    visits = calibrate(placed, queries, tree, k, target_recall)
    sizes = placed.groupBy("leaf").count().collect()  # one row per leaf of the bounded tree
    blocks = {r["leaf"]: -(-r["count"] // BLOCK_VECTORS) for r in sizes}
    held = np.zeros(tree.leaves, np.int64)
    held[[r["leaf"] for r in sizes]] = [r["count"] for r in sizes]
    repeats = queries.groupBy("vec_id").agg(F.count("*").alias("own")).where("own > 1")
    asking = lookup_join(queries, staged(repeats, "repeats"), ["vec_id"], "left", [F.xxhash64("vector")])
    routed = staged(
        asking.select("vec_id", "vector", F.coalesce("own", F.lit(1)).alias("own")).mapInArrow(
            lambda b: _route(b, tree, visits, held, k), "vec_id long, vector array<double>, leaf long"
        ),
        "visits",
    )
    asked = routed.groupBy("leaf").count().collect()
    groups = {r["leaf"]: -(-r["count"] // BLOCK_QUERIES) for r in asked}
    both = _dealt(placed, groups, blocks, False).unionAll(_dealt(routed, blocks, groups, True))
    found = both.groupBy("leaf", "rows", "asks").applyInPandas(
        lambda frame: _compare(frame, k), "query_id long, vec_id long, score double"
    )
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


_FOUND = "query_id long, rank int, vec_id long, score double"


def _dealt(rows: DataFrame, others: dict[int, int], own: dict[int, int], asking: bool) -> DataFrame:
    """Rows with the blocks they belong to: their own by hash, and all of the other side."""
    spark = rows.sparkSession
    table = spark.createDataFrame(
        [(leaf, n, others[leaf]) for leaf, n in own.items() if leaf in others],
        "leaf long, own long, others long",
    )
    mine = F.pmod(F.xxhash64("vec_id"), F.col("own"))
    theirs = F.explode(F.sequence(F.lit(0).cast("long"), F.col("others") - 1))
    spread = rows.join(F.broadcast(table), "leaf").select(
        "leaf", mine.alias("mine"), theirs.alias("theirs"), "vec_id", "vector"
    )
    row, ask = ("theirs", "mine") if asking else ("mine", "theirs")
    return spread.select(
        "leaf", F.col(row).alias("rows"), F.col(ask).alias("asks"), F.lit(asking).alias("asking"), "vec_id", "vector"
    )


def _matrix(column: pa.Array) -> np.ndarray:
    if not len(column):
        return np.zeros((0, 1))
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _assign(batches: Iterator[pa.RecordBatch], tree: Tree) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            leaves = tree.leaf_of(_matrix(batch.column(1)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(leaves)], ["vec_id", "vector", "leaf"])


def _route(
    batches: Iterator[pa.RecordBatch], tree: Tree, visits: int, rows: np.ndarray, k: int
) -> Iterator[pa.RecordBatch]:
    """Queries with each leaf they visit; a query's own rows (``own``) are no candidates of it."""
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            some = batch.slice(at, 256)
            own = some.column(2).to_pylist()
            points = _matrix(some.column(1))
            met = [tree.traverse(q, visits, rows, k + n) for q, n in zip(points, own, strict=True)]
            row = np.repeat(np.arange(len(met)), [len(m) for m in met])
            leaves = pa.array(np.concatenate(met).astype(np.int64))
            yield pa.RecordBatch.from_arrays(
                [some.column(0).take(pa.array(row)), some.column(1).take(pa.array(row)), leaves],
                ["vec_id", "vector", "leaf"],
            )


def calibrate(
    placed: DataFrame, queries: DataFrame, tree: Tree, k: int, target_recall: float
) -> int:
    """How many leaves a query visits: the fewest that hold enough of the true neighbours.

    A bounded number of queries meets all rows, block by block; each task keeps the best of
    its rows for each of them.
    """
    chosen = queries.orderBy(F.xxhash64("vec_id"), "vec_id").limit(CALIBRATION).select("vec_id", "vector").toArrow()
    if not chosen.num_rows:
        return 1
    ids = chosen.column(0).to_numpy()
    points = _matrix(chosen.column(1).combine_chunks())

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK_VECTORS):
                some = batch.slice(at, BLOCK_VECTORS)
                scores = inner_products(points, _matrix(some.column(1)))
                names, leaves = some.column(0).to_numpy(), some.column(2).to_numpy()
                q, n = _top(scores, ids, names, k)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(q), pa.array(names[n]), pa.array(scores[q, n]), pa.array(leaves[n])],
                    ["q", "vec_id", "score", "leaf"],
                )

    order = Window.partitionBy("q").orderBy(F.desc("score"), "vec_id")
    true = (
        placed.mapInArrow(best, "q long, vec_id long, score double, leaf long")
        .withColumn("n", F.row_number().over(order))
        .where(F.col("n") <= k)
        .select("q", "leaf")
        .toPandas()
    )
    if true.empty:
        return 1
    rank = np.zeros((len(ids), tree.leaves), np.int64)
    for q, point in enumerate(points):
        rank[q, tree.traverse(point, tree.leaves)] = np.arange(tree.leaves)
    needed = np.sort(rank[true["q"].to_numpy(), true["leaf"].to_numpy()])
    visits = 1
    while visits < tree.leaves and np.searchsorted(needed, visits) < target_recall * len(needed):
        visits = min(tree.leaves, visits + max(1, visits // 8))
    return visits


def inner_products(queries: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Products summed in the order of the components, so that equal vectors score alike."""
    scores = np.zeros((len(queries), len(vectors)))
    for d in range(queries.shape[1]):
        scores += queries[:, d, None] * vectors[None, :, d]
    return scores


def _top(scores: np.ndarray, queries: np.ndarray, names: np.ndarray, k: int):
    """Places (query, vector) of each query's ``k`` best; ties go to smaller ids."""
    kept = np.where(queries[:, None] == names[None, :], -np.inf, scores)
    if kept.shape[1] > k:
        least = -np.partition(-kept, k - 1, axis=1)[:, k - 1 : k]
        q, n = np.nonzero((kept >= least) & (kept > -np.inf))
    else:
        q, n = np.nonzero(kept > -np.inf)
    order = np.lexsort((names[n], -kept[q, n], q))
    q, n = q[order], n[order]
    place = np.arange(len(q)) - np.searchsorted(q, q)
    return q[place < k], n[place < k]


def _compare(frame: pd.DataFrame, k: int) -> pd.DataFrame:
    asking = frame["asking"].to_numpy()
    ids = frame["vec_id"].to_numpy()
    points = np.stack(frame["vector"].to_list()) if len(frame) else np.zeros((0, 1))
    queries, names, vectors = ids[asking], ids[~asking], points[~asking]
    found = []
    for at in range(0, len(queries), 128):
        some = queries[at : at + 128]
        scores = inner_products(points[asking][at : at + 128], vectors)
        q, n = _top(scores, some, names, k)
        found.append(pd.DataFrame({"query_id": some[q], "vec_id": names[n], "score": scores[q, n]}))
    if not found:
        return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
    return pd.concat(found, ignore_index=True)
