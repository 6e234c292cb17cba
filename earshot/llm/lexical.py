"""Ranked lexical search: the best documents of every item by exact integer scores, found through sparse ball trees.

A document is a sparse vector over the items' terms. Its score for an item is an inner product: the
term's weight times a saturated, length-corrected frequency, in integers. Every task builds ball
trees over the documents it holds: a node has a centroid and radii, and no document below it can
score more than the item's product with the centroid plus the item's norm times the radius. That
bound is kept per group of terms (the terms of a single item are a group, terms that items share are
cut into groups by frequency) and added up, which is what makes it tight: most terms of an item
occur in few documents. Nodes are visited best bound first, and whole subtrees stay unvisited once
the best bound left is below the item's current k-th score. Bounds are computed in doubles and
rounded up by more than their error; leaves are scored exactly in 64-bit integers, so the result is
that of scoring every document.

Spark counts terms where the documents lie, keeps (doc_id, length, terms, frequencies) as a table,
and gathers corpus statistics from it. A hashed sample of documents is searched first: its k-th
score per item is a bound every task may start from, since it is the score of real documents. So
tasks emit few rows per item, at any size, and a window picks the k best of all.

Items are broadcast in blocks of checked size (``item_bytes`` of text); more blocks mean more passes.

Defined results: null texts have no terms; documents and items without terms do not occur in the
result; equal scores are ranked by document id, null ids last; repeated documents each take a rank,
repeated items each have their own ranking; empty tables give an empty result; columns besides the
id and the text are not read.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from earshot.functions.hashing import spread
from earshot.llm.words import utf8
from earshot.session import stored

TOP_K = 50
ITEM_BYTES = 2 << 20  # item text that is searched for at a time
SAMPLE = 16  # one in so many documents is searched first, for the scores to start from
SHARED = 512  # groups of the terms that several items share
SLACK = 1e-9  # relative; doubles err by less than 1e-15 for each of at most a few thousand terms

COUNTED = "doc_id long, n long, terms array<int>, tf array<long>"
FOUND = "item int, item_id {}, doc_id long, score long, visited long, leaves long"


@dataclass(frozen=True)
class Shape:
    """The size of a tree, which bounds a task's memory and never changes a result."""

    leaf: int = 16  # documents of a leaf, at most
    rows: int = 8_192  # documents of a tree
    entries: int = 2 << 20  # terms of all documents of a tree
    cells: int = 8 << 20  # nodes times terms of the items


_TERM = bytes(b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else 0x20 for b in range(256))


def split_terms(text: bytes) -> list[bytes]:
    """Runs of digits, letters and non-ASCII characters, A-Z lower-cased."""
    return text.translate(_TERM).split()


class Items:
    """A block of items: their terms, numbered so that the terms of a group are neighbours."""

    def __init__(self, ids: list, texts: list[bytes]):
        found = [sorted(set(split_terms(t))) for t in texts]
        holders: dict[bytes, list] = {}
        for i, terms in enumerate(found):
            for t in terms:
                holders.setdefault(t, [0, i])[0] += 1
        own = {t: i for t, (n, i) in holders.items() if n == 1}
        common = sorted((t for t in holders if t not in own), key=lambda t: (-holders[t][0], t))
        grouped = [*((len(ids) + k * SHARED // len(common), t) for k, t in enumerate(common)), *((i, t) for t, i in own.items())]
        grouped.sort()
        self.ids = ids
        self.number = {t: k for k, (_, t) in enumerate(grouped)}
        names = np.array([g for g, _ in grouped], np.int64)
        self.group = np.unique(names, return_inverse=True)[1]  # group of every term, rising
        self.starts = np.flatnonzero(np.diff(names, prepend=-1))  # first term of every group
        self.terms = [np.sort(np.array([self.number[t] for t in terms], np.int64)) for terms in found]

    def weigh(self, n_docs: int, df: np.ndarray) -> None:
        self.weight = np.floor(1000 * np.log((2 * n_docs + 2) / (2 * df + 1))).astype(np.int64)


def count_terms(docs: DataFrame, items: Items) -> DataFrame:
    """COUNTED: the number of terms of every document, and the frequencies of those that items hold."""
    held = docs.sparkSession.sparkContext.broadcast(items.number)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        get = held.value.get
        for batch in batches:
            n, terms, tf = [], [], []
            for text in batch.column(1):
                words = split_terms(text.as_py())
                known = np.fromiter((i for i in map(get, words) if i is not None), np.int64)
                which, often = np.unique(known, return_counts=True)
                n.append(len(words))
                terms.append(which.astype(np.int32))
                tf.append(often.astype(np.int64))
            offsets = np.concatenate(([0], np.cumsum([len(t) for t in terms]))).astype(np.int32)
            lists = [
                pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(c) if c else np.zeros(0, kind), kind()))
                for c, kind in ((terms, pa.int32), (tf, pa.int64))
            ]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), *lists], ["doc_id", "n", "terms", "tf"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), utf8("text").alias("text")).mapInArrow(count, COUNTED)


# ---- inside the tasks -------------------------------------------------------------------------


class BallTree:
    """A complete binary tree over documents; node j has the children 2j + 1 and 2j + 2."""

    def __init__(self, items: Items, lengths: np.ndarray, terms: np.ndarray, gain: np.ndarray, ids: np.ndarray, null: np.ndarray, leaf: int = Shape.leaf):
        """``lengths`` are the numbers of entries per document, at least one each; ``gain`` their integer values."""
        n, n_terms = len(lengths), len(items.weight)
        self.depth = max(0, int(np.ceil(np.log2(n / leaf))))
        scale = np.sqrt(items.weight.astype(np.float64))  # both sides of the product carry one root of the weight
        values = gain * scale[terms]
        ends = np.cumsum(lengths)
        starts = ends - lengths
        unit = values / np.repeat(np.sqrt(np.add.reduceat(values * values, starts)) + 1e-300, lengths)
        order = np.arange(n)
        centroids, radii = [], []
        for level in range(self.depth + 1):
            nodes = 1 << level
            self.bounds = n * np.arange(nodes + 1) // nodes
            node = np.empty(n, np.int64)  # of every document
            node[order] = np.repeat(np.arange(nodes), np.diff(self.bounds))
            at = np.repeat(node, lengths)
            mean = np.bincount(at * n_terms + terms, values, nodes * n_terms).reshape(nodes, n_terms)
            mean /= np.diff(self.bounds)[:, None]
            squares = np.add.reduceat(mean * mean, items.starts, axis=1)
            off = values * (values - 2 * mean[at, terms])
            radii.append(self._radii(items, squares, off, at, terms, starts))
            centroids.append(mean)
            if level == self.depth:
                break
            # Split by the line between two documents of very different directions.
            far = self._farthest(-np.add.reduceat(unit * mean[at, terms], starts), node, nodes)
            first = self._towards(far, lengths, starts, terms, unit, at, n_terms)
            other = self._farthest(-first, node, nodes)
            side = first - self._towards(other, lengths, starts, terms, unit, at, n_terms)
            order = np.lexsort((np.arange(n), side, node))
        self.centroids = np.ascontiguousarray(np.concatenate(centroids).T)  # terms x nodes
        self.radii = np.ascontiguousarray(np.concatenate(radii).T)  # groups x nodes
        # Documents in leaf order, so that the entries of a leaf are one slice.
        self.lengths = lengths[order]
        self.ends = np.concatenate(([0], np.cumsum(self.lengths)))
        moved = np.repeat(starts[order] - self.ends[:-1], self.lengths) + np.arange(len(terms))
        self.terms, self.gain, self.ids, self.null = terms[moved], gain[moved], ids[order], null[order]
        self.root_weight = scale

    @staticmethod
    def _radii(items, squares, off, at, terms, starts):
        """Per node and group, the largest distance of a document from the centroid, rounded up."""
        group = items.group[terms]
        fresh = np.empty(len(terms), bool)  # a run is the entries of one document in one group
        fresh[0] = True
        np.not_equal(group[1:], group[:-1], out=fresh[1:])
        fresh[starts] = True
        runs = np.flatnonzero(fresh)
        most = squares.copy()  # documents without a term of the group
        np.maximum.at(most, (at[runs], group[runs]), squares[at[runs], group[runs]] + np.add.reduceat(off, runs))
        return np.sqrt(np.maximum(most, 0) + SLACK * SLACK * squares.max(initial=0) + 1e-12 * most.max(initial=0))

    @staticmethod
    def _farthest(distance, node, nodes):
        """The document of the largest distance in every node."""
        by = np.lexsort((distance, node))
        return by[np.cumsum(np.bincount(node, minlength=nodes)) - 1]

    @staticmethod
    def _towards(pivots, lengths, starts, terms, values, at, n_terms):
        """Every document's product with the pivot of its node."""
        dense = np.zeros((len(pivots), n_terms))
        for j, p in enumerate(pivots):
            own = slice(starts[p], starts[p] + lengths[p])
            dense[j, terms[own]] = values[own]
        return np.add.reduceat(values * dense[at, terms], starts)

    def limits(self, items: Items, item: int) -> np.ndarray:
        """For every node, a score that no document below it exceeds."""
        terms = items.terms[item]
        q = self.root_weight[terms]
        group, where = np.unique(items.group[terms], return_inverse=True)
        norms = np.sqrt(np.bincount(where, q * q))
        return (q @ self.centroids[terms] + norms @ self.radii[group]) * (1 + SLACK) + 1

    def search(self, items: Items, item: int, best: Best, dense: np.ndarray) -> tuple[int, int]:
        """Offer ``best`` every document that can still enter it; (leaves visited, leaves)."""
        limits = self.limits(items, item)
        inner = (1 << self.depth) - 1
        heap, visited = [(-limits[0], 0)], 0
        dense[items.terms[item]] = items.weight[items.terms[item]]
        while heap:
            limit, j = heapq.heappop(heap)
            if -limit < best.least:
                break  # nor can any node left: they are visited by falling bounds
            if j < inner:
                for child in (2 * j + 1, 2 * j + 2):
                    heapq.heappush(heap, (max(limit, -limits[child]), child))
                continue
            visited += 1
            a, b = self.bounds[j - inner], self.bounds[j - inner + 1]
            own = slice(self.ends[a], self.ends[b])
            scores = np.add.reduceat(self.gain[own] * dense[self.terms[own]], self.ends[a:b] - self.ends[a])
            best.offer(scores, self.ids[a:b], self.null[a:b])
        dense[items.terms[item]] = 0
        return visited, inner + 1


class Best:
    """The k best (score, id) met so far; ``least`` is the score a document needs to enter."""

    def __init__(self, k: int, least: int):
        self.k, self.least, self.heap = k, max(least, 1), []

    def offer(self, scores, ids, null) -> None:
        for i in np.flatnonzero(scores >= self.least):
            entry = (int(scores[i]), not null[i], -int(ids[i]))  # a larger entry ranks before a smaller one
            if len(self.heap) < self.k:
                heapq.heappush(self.heap, entry)
            else:
                heapq.heappushpop(self.heap, entry)
            if len(self.heap) == self.k:
                self.least = max(self.least, self.heap[0][0])


def _trees(batches: Iterator[pa.RecordBatch], items: Items, n_docs: int, n_terms: int, shape: Shape) -> Iterator[BallTree]:
    """Trees over runs of documents, of bounded entries and nodes."""
    nodes = max(1, shape.cells // max(1, 2 * len(items.weight)))
    rows = min(shape.rows, shape.leaf * nodes)
    for batch in batches:
        lists = batch.column(2)
        ends = lists.offsets.to_numpy().astype(np.int64)
        terms = lists.flatten().to_numpy().astype(np.int64)
        tf = batch.column(3).flatten().to_numpy()
        ends = ends - ends[0]
        lengths = np.diff(ends)
        n = batch.column(1).to_numpy()
        m = 100 - 50 + (50 * n * n_docs) // n_terms
        gain = (1_000_000_000 * tf) // (1000 * tf + 20 * np.repeat(m, lengths))
        ids = batch.column(0).fill_null(0).to_numpy()
        null = batch.column(0).is_null().to_numpy(zero_copy_only=False)
        start = 0
        while start < len(n):
            stop = max(start + 1, min(start + rows, int(np.searchsorted(ends, ends[start] + shape.entries, "right")) - 1))
            some = slice(ends[start], ends[stop])
            part = slice(start, stop)
            yield BallTree(items, lengths[part], terms[some], gain[some], ids[part], null[part], shape.leaf)
            start = stop


# ---- the plan ---------------------------------------------------------------------------------


def _find(counted: DataFrame, held, n_docs: int, n_terms: int, k: int, least, id_type: str, shape: Shape) -> DataFrame:
    """FOUND: what every task finds among its documents; ``least`` is a score per item to start from."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = held.value
        best = [Best(k, x) for x in least]
        dense = np.zeros(len(items.weight), np.int64)
        seen = np.zeros((len(best), 2), np.int64)
        for tree in _trees(batches, items, n_docs, n_terms, shape):
            for i, found in enumerate(best):
                if len(items.terms[i]):
                    seen[i] += tree.search(items, i, found, dense)
        rows = [(i, -d if known else None, s) for i, b in enumerate(best) for s, known, d in b.heap]
        if rows:
            which, docs, scores = zip(*rows)
            counts = seen[list(which)]
            yield pa.RecordBatch.from_arrays([
                pa.array(which, pa.int32()), items.ids.take(pa.array(which)), pa.array(docs, pa.int64()), pa.array(scores, pa.int64()),
                pa.array(counts[:, 0]), pa.array(counts[:, 1]),
            ], ["item", "item_id", "doc_id", "score", "visited", "leaves"])

    return counted.where("size(terms) > 0").mapInArrow(search, FOUND.format(id_type))


def _first(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _search_block(docs: DataFrame, block: DataFrame, k: int, shape: Shape) -> DataFrame:
    spark = docs.sparkSession
    id_type = block.schema["item_id"].dataType.simpleString()
    table = block.toArrow().combine_chunks()  # bounded by item_bytes and the longest item
    items = Items(table.column("item_id").combine_chunks(), table.column("text").to_pylist())
    counted = stored(count_terms(docs, items), "terms")
    n_docs, n_terms = counted.where("n > 0").agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    df = np.zeros(len(items.number), np.int64)
    for term, n in counted.select(F.explode("terms").alias("t")).groupBy("t").count().toArrow().to_pandas().itertuples(index=False):
        df[term] = n  # a row per term of the block
    items.weigh(n_docs, df)
    held = spark.sparkContext.broadcast(items)
    least = np.ones(len(items.ids), np.int64)
    if n_docs:
        sample = counted.where(spread(SAMPLE, "doc_id", "n", "terms") == 0)
        tops = _first(_find(sample, held, n_docs, n_terms, k, least, id_type, shape), k).where(F.col("rank") == k).select("item", "score")
        for item, score in tops.collect():  # a row per item of the block
            least[item] = score
    found = _find(counted, held, n_docs, max(n_terms, 1), k, least, id_type, shape)
    return _first(found, k)


def rank_documents(docs: DataFrame, items: DataFrame, k: int = TOP_K, item_bytes: int = ITEM_BYTES, shape: Shape = Shape()) -> DataFrame:
    """(item_id, rank, doc_id, score, visited, leaves): the ``k`` best documents of every item, rank from 1.

    ``visited`` and ``leaves`` tell how many leaves the task that found the row scored for the item,
    and how many it holds.
    """
    rows = stored(items.select("item_id", utf8("text").alias("text"), F.monotonically_increasing_id().alias("row")), "items")
    total = rows.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    blocks = total // item_bytes + 1
    parts = [_search_block(docs, rows.where(spread(blocks, "row") == b).drop("row"), k, shape) for b in range(blocks)]
    return reduce(DataFrame.unionByName, parts).select("item_id", "rank", "doc_id", "score", "visited", "leaves")
