"""Random-projection forest: approximate neighbours through many trees that vote.

Fitting draws one random direction per tree and level and takes the medians of the projections, node
by node, from a bounded hashed sample of the vectors (``SAMPLE``); the trees are as deep as that
sample and a bound on the nodes allow. Indexing sends every vector to its leaf in every tree.

A query enters each tree by margin: how likely a near neighbour lies on the other side of a split is
known from the distance to the split and from the spread of neighbours along a direction, which is
measured on the sample. The best few leaves of every tree are probed, a vector's vote is the sum of
the likelihoods of its leaves, and only the best voted share of the vectors is compared with the
query. So what is scored is bounded by ``share``, whatever the data look like.

Search cuts queries and vectors into blocks of bounded size, and a pair of blocks is one task, which
returns at most k rows per query. No pairs are shuffled.
"""

from __future__ import annotations

import sys
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from earshot.functions.hashing import key_hash, spread

cloudpickle.register_pickle_by_value(sys.modules[__name__])

TREES = 128
PROBES = 8  # leaves of every tree that a query visits
SHARE = 0.1  # of the vectors that are compared with a query, at most
LEAF = 16  # vectors of a leaf aimed at
SAMPLE = 65_536  # vectors that splits are fitted on
MAX_NODES = 8 << 20  # of all trees, which are broadcast: 32 MB
QUERY_BLOCK = 1_024
ITEM_BLOCK = 32_768
CELLS = 1 << 20  # entries of an array over queries, trees and probes

FOUND = "query_id long, id long, score double, scored long, touched long"


@dataclass(frozen=True)
class Forest:
    directions: np.ndarray  # dims x (trees * depth)
    splits: np.ndarray  # trees x (2 ** depth - 1), level by level
    depth: int
    spread: float  # of a near neighbour along a direction

    @property
    def trees(self) -> int:
        return len(self.splits)

    def _projections(self, matrix: np.ndarray) -> np.ndarray:
        return (matrix @ self.directions).reshape(len(matrix), self.trees, self.depth)

    def leaves(self, matrix: np.ndarray) -> np.ndarray:
        """The leaf of every vector in every tree."""
        across = self._projections(matrix)
        tree = np.arange(self.trees)
        node = np.zeros((len(matrix), self.trees), np.int64)
        for level in range(self.depth):
            node = 2 * node + (across[:, :, level] > self.splits[tree, (1 << level) - 1 + node])
        return node.astype(np.int32)

    def probes(self, matrix: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Per vector and tree, the ``n`` likeliest leaves (-1 for none) and their likelihoods."""
        across = self._projections(matrix)
        tree = np.arange(self.trees)[:, None]
        node = np.zeros((len(matrix), self.trees, 1), np.int64)
        chance = np.zeros((len(matrix), self.trees, 1))  # logarithms
        for level in range(self.depth):
            margin = (across[:, :, level, None] - self.splits[tree, (1 << level) - 1 + node]) / self.spread
            right = -np.logaddexp(0, -1.702 * margin)  # of the normal distribution's integral, nearly
            left = right - 1.702 * margin
            node = np.concatenate((2 * node, 2 * node + 1), 2)
            chance = np.concatenate((chance + left, chance + right), 2)
            if node.shape[2] > n:
                best = np.argpartition(-chance, n - 1, axis=2)[:, :, :n]
                node, chance = (np.take_along_axis(a, best, 2) for a in (node, chance))
        return node.astype(np.int32), np.exp(chance).astype(np.float32)


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False).reshape(len(column), -1)


def fit_forest(vectors: DataFrame, trees: int = TREES, leaf: int = LEAF, sample: int = SAMPLE, seed: int = 1) -> Forest:
    """Fit on (id, features), of one length and not empty."""
    taken = vectors.orderBy(key_hash("id", salt="forest"), "id").limit(sample)
    matrix = _matrix(taken.select(F.col("features").cast("array<double>").alias("f")).toArrow().combine_chunks().column("f").combine_chunks())
    n = vectors.count()
    depth = max(1, min(int(np.ceil(np.log2(max(2, n / leaf)))), int(np.log2(max(2, len(matrix) / 2))), int(np.log2(MAX_NODES / trees))))
    draw = np.random.default_rng(seed)
    dims = matrix.shape[1]
    directions = draw.normal(size=(dims, trees * depth))
    directions /= np.linalg.norm(directions, axis=0)
    splits = np.zeros((trees, (1 << depth) - 1))
    for t in range(trees):
        across = matrix @ directions[:, t * depth : (t + 1) * depth]
        node = np.zeros(len(matrix), np.int64)
        for level in range(depth):
            order = np.lexsort((across[:, level], node))
            counts = np.bincount(node, minlength=1 << level)
            middle = np.cumsum(counts) - counts + (counts - 1) // 2
            own = np.where(counts > 0, across[order[np.minimum(middle, len(matrix) - 1)], level], 0.0)
            splits[t, (1 << level) - 1 : (2 << level) - 1] = own
            node = 2 * node + (across[:, level] > own[node])
    return Forest(directions, splits.astype(np.float32), depth, _spread(matrix, draw))


def _spread(matrix: np.ndarray, draw, near: int = 10, asked: int = 256) -> float:
    """How far a near neighbour typically lies along a direction."""
    some = matrix[draw.permutation(len(matrix))[:asked]]
    squares = (some**2).sum(1)[:, None] + (matrix**2).sum(1) - 2 * some @ matrix.T
    k = min(near, len(matrix) - 1)
    kth = np.partition(squares, k, axis=1)[:, k]
    return float(np.sqrt(max(np.median(kth), 0) / matrix.shape[1])) or 1e-9


def index_forest(forest: Forest, vectors: DataFrame) -> DataFrame:
    """(id, features, leaves): the vectors where they lie, with their leaf in every tree."""
    held = vectors.sparkSession.sparkContext.broadcast(forest)

    def index(batches):
        for batch in batches:
            if batch.num_rows:
                leaves = held.value.leaves(_matrix(batch.column(1)))
                lists = pa.ListArray.from_arrays(np.arange(0, leaves.size + 1, leaves.shape[1], dtype=np.int32), pa.array(leaves.ravel()))
                yield pa.RecordBatch.from_arrays([*batch.columns, lists], ["id", "features", "leaves"])

    rows = vectors.select(F.col("id").cast("long").alias("id"), F.col("features").cast("array<double>").alias("features"))
    return rows.mapInArrow(index, "id long, features array<double>, leaves array<int>")


def forest_search(
    forest: Forest,
    queries: DataFrame,
    indexed: DataFrame,
    k: int,
    share: float = SHARE,
    probes: int = PROBES,
    query_block: int = QUERY_BLOCK,
    item_block: int = ITEM_BLOCK,
) -> DataFrame:
    """(query_id, id, score, rank, scored, touched): k nearest among the best voted ``share`` of the vectors.

    ``scored`` counts the vectors whose distance to the query was computed, ``touched`` the entries
    of probed leaves, over all blocks. ``indexed`` is best a stored table; it is read twice.
    """
    held = queries.sparkSession.sparkContext.broadcast(forest)
    n_q, n_x = queries.count(), indexed.count()
    counts = {"qn": -(-n_q // query_block) or 1, "xn": -(-n_x // item_block) or 1}
    q = queries.select(F.col("query_id").cast("long").alias("query_id"), F.col("features").cast("array<double>").alias("features"))
    q = q.withColumns({"qb": spread(counts["qn"], "query_id"), "xb": F.explode(F.sequence(F.lit(0), F.lit(counts["xn"] - 1)))})
    x = indexed.withColumns({"xb": spread(counts["xn"], "id"), "qb": F.explode(F.sequence(F.lit(0), F.lit(counts["qn"] - 1)))})

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        return _search_block(held.value, left.combine_chunks(), right.combine_chunks(), k, share, probes)

    found = q.groupBy("qb", "xb").cogroup(x.groupBy("qb", "xb")).applyInArrow(search, FOUND)
    best = Window.partitionBy("query_id")
    ranked = found.withColumns({
        "rank": F.row_number().over(best.orderBy("score", "id")),
        "scored": F.sum("scored").over(best),
        "touched": F.sum("touched").over(best),
    })
    return ranked.where(F.col("rank") <= k).select("query_id", "id", "score", "rank", "scored", "touched")


def _search_block(forest: Forest, left: pa.Table, right: pa.Table, k: int, share: float, probes: int) -> pa.Table:
    out = []
    if left.num_rows and right.num_rows:
        queries, items = (_matrix(t.column("features").combine_chunks()) for t in (left, right))
        asked, ids = left.column("query_id").to_numpy(), right.column("id").to_numpy()
        n = len(ids)
        quota = min(n, max(k, int(share * n)))
        # Vectors in leaf order per tree: the members of a leaf are one slice.
        leaves = right.column("leaves").combine_chunks().flatten().to_numpy().reshape(n, -1) + (np.arange(forest.trees, dtype=np.int64) << forest.depth)
        flat = leaves.T.ravel()
        order = np.argsort(flat, kind="stable")
        members = order % n
        starts = np.searchsorted(flat[order], np.arange((forest.trees << forest.depth) + 1))
        step = max(1, CELLS // (forest.trees * probes))
        for first in range(0, len(asked), step):
            leaf, chance = forest.probes(queries[first : first + step], probes)
            leaf = (leaf + (np.arange(forest.trees)[:, None] << forest.depth)).reshape(len(leaf), -1)
            chance = chance.reshape(len(chance), -1)
            for i in range(len(leaf)):
                sizes = starts[leaf[i] + 1] - starts[leaf[i]]
                total = int(sizes.sum())
                at = np.arange(total) + np.repeat(starts[leaf[i]] - (np.cumsum(sizes) - sizes), sizes)
                votes = np.bincount(members[at], np.repeat(chance[i], sizes), n)
                chosen = np.argpartition(-votes, quota - 1)[:quota] if quota < n else np.arange(n)
                cost = np.zeros(len(chosen))
                for d in range(items.shape[1]):  # term by term, so that scores do not depend on the block
                    cost += (items[chosen, d] - queries[first + i, d]) ** 2
                best = np.lexsort((ids[chosen], cost))[:k]
                row = np.zeros((len(best), 2), np.int64)
                row[0] = quota, total  # counted once per query and block
                out.append((np.full(len(best), asked[first + i]), ids[chosen[best]], cost[best], row[:, 0], row[:, 1]))
    columns = [np.concatenate(c) for c in zip(*out)] if out else [np.zeros(0, np.int64)] * 2 + [np.zeros(0)] + [np.zeros(0, np.int64)] * 2
    return pa.table([pa.array(c) for c in columns], names=["query_id", "id", "score", "scored", "touched"])


def search_report(found: DataFrame, exact: DataFrame, n: int) -> DataFrame:
    """(queries, recall, scored_share): one row on a search whose rows carry ``scored``, against the exact answer."""
    hits = found.select("query_id", "id").withColumn("hit", F.lit(1))
    per_query = exact.join(hits, ["query_id", "id"], "left").groupBy("query_id").agg((F.count("hit") / F.count(F.lit(1))).alias("recall"))
    cost = found.groupBy("query_id").agg((F.max("scored") / F.lit(max(n, 1))).alias("share"))
    return per_query.join(cost, "query_id", "left").agg(
        F.count(F.lit(1)).alias("queries"), F.avg("recall").alias("recall"), F.max("share").alias("scored_share")
    )
