"""Near-duplicate vectors by spherical-cap filters.

A filter is a direction; a vector belongs to all filters whose inner product with it exceeds a
threshold, and only vectors that share a filter are compared. Directions are structured random
product codes: after a random rotation the space is cut into two halves with ``k`` random
directions each, and every pair of them is a filter, ``k * k`` in all. A vector's filters are
list-decoded: the inner product is the sum over the halves, so only first halves that can reach
the threshold with the best second half are opened. ``k`` follows from the number of vectors, so
that a filter holds a bounded number of them and a vector is in about ``FILTERS`` filters.

Vectors meet by the first half of their filters, once per first half; the rest of the list is
decoded again where they meet. A pair is verified in double precision and counted in the smallest
first half it shares, so every verified link counts once. First halves with many vectors are cut into blocks,
and each pair of blocks is a task. Equal vectors are one class and never compared with each other.
Tasks give link counts and a spanning forest, never pairs.

Defined results: vectors that are null, empty, zero, or hold a null or non-finite component, have
no links and are a component of their own; vectors of different lengths never link; component_id
is the smallest id of the component; repeated rows are linked copies; an empty table gives an
empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from math import ceil, sqrt
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from earshot.llm.bktree import Unions
from earshot.llm.components import connected_components
from earshot.session import stored

COSINE = 0.95
FILTERS = 24  # filters a vector is expected to be in
FEWEST = 6  # a vector in fewer lowers its threshold
PER_FILTER = 8  # vectors a filter is expected to hold
MAX_BLOCK = 4096  # vectors of one first half that one side of a task compares
TILE = 1024
SEED = 11


@dataclass(frozen=True)
class Codes:
    rotation: np.ndarray
    first: np.ndarray  # half dimensions x k
    second: np.ndarray
    threshold: float

    @property
    def k(self) -> int:
        return self.first.shape[1]

    def decode(self, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, filter) for every filter at or above the row's threshold."""
        turned = unit @ self.rotation
        half = self.first.shape[0]
        a, b = turned[:, :half] @ self.first, turned[:, half:] @ self.second
        best = (np.sort(a, 1)[:, -4:, None] + np.sort(b, 1)[:, None, -4:]).reshape(len(unit), 16)
        threshold = np.minimum(self.threshold, np.sort(best, 1)[:, -FEWEST])
        rows, filters = [], []
        row, j = np.nonzero(a + b.max(1)[:, None] >= threshold[:, None])
        step = max(1, 4_000_000 // self.k)
        for i in range(0, len(row), step):
            r, f = row[i : i + step], j[i : i + step]
            at, other = np.nonzero(b[r] + a[r, f][:, None] >= threshold[r][:, None])
            rows.append(r[at])
            filters.append(f[at] * self.k + other)
        found = np.unique(np.stack([np.concatenate(rows), np.concatenate(filters)], 1), axis=0)
        return found[:, 0], found[:, 1]


@lru_cache(maxsize=8)
def codes(dim: int, k: int, filters: float = FILTERS, seed: int = SEED) -> Codes:
    draw = np.random.default_rng([seed, dim, k])
    rotation = np.linalg.qr(draw.normal(size=(dim, dim)))[0]
    half = (dim + 1) // 2
    parts = []
    for d in (half, max(dim - half, 1)):
        x = draw.normal(size=(d, k))
        parts.append(x / np.linalg.norm(x, axis=0) / sqrt(2))
    if dim == 1:
        parts[1] = np.zeros((0, k))
    share = min(filters / k**2, 0.5)
    return Codes(rotation, parts[0], parts[1], NormalDist().inv_cdf(1 - share) / sqrt(dim))


def code_size(n: int) -> int:
    """Directions per half for n vectors."""
    return max(16, ceil(sqrt(n * FILTERS / PER_FILTER)))


def _unit(rows: list | np.ndarray) -> np.ndarray:
    x = np.asarray(rows, np.float64)
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _by_size(batch: pa.RecordBatch) -> Iterator[tuple[int, pa.RecordBatch, np.ndarray]]:
    """The batch cut by vector length, with unit vectors."""
    sizes = np.diff(batch["e"].offsets.to_numpy())
    for dim in np.unique(sizes):
        part = batch.take(pa.array(np.flatnonzero(sizes == dim)))
        for at in range(0, part.num_rows, 2048):
            some = part.slice(at, 2048)
            yield int(dim), some, _unit(some["e"].flatten().to_numpy(zero_copy_only=False).reshape(-1, dim))


def _key_rows(dim: int, unit: np.ndarray, sizes: dict[int, int]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (row, first half) of the filters of each row."""
    k = sizes[dim]
    row, filters = codes(dim, k).decode(unit)
    pairs = np.unique(np.stack([row, filters // k], 1), axis=0)
    return pairs[:, 0], pairs[:, 1]


def link_vectors(classes: DataFrame, cosine: float = COSINE, max_block: int = MAX_BLOCK) -> DataFrame:
    """(node, links, other): link counts by task, and for a spanning forest the node joined.

    ``classes`` has node, n (copies) and e, a valid vector.
    """
    counted = classes.groupBy(F.size("e").alias("d")).agg(F.count(F.lit(1)).alias("n")).collect()
    sizes = {r.d: code_size(r.n) for r in counted}

    def first_halves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for dim, some, unit in _by_size(batch):
                half, n = np.unique(_key_rows(dim, unit, sizes)[1], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(half), dim, np.int32)), pa.array(half), pa.array(n)], ["d", "half", "n"])

    keys = classes.select("e").mapInArrow(first_halves, "d int, half long, n long")
    hot = keys.groupBy("d", "half").agg(F.sum("n").alias("n")).where(F.col("n") > max_block).collect()  # at most k rows
    blocks = {(r.d, r.half): -(-r.n // max_block) for r in hot}
    kind = classes.schema["e"].dataType.simpleString()
    names = ["d", "half", "low", "high", "own", "node", "n", "e"]

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for dim, some, unit in _by_size(batch):
                row, half = _key_rows(dim, unit, sizes)
                node = some["node"].to_numpy()
                parts = np.array([blocks.get((dim, h), 1) for h in half], np.int64)
                own = (node[row].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)).astype(np.int64) % parts
                at = np.repeat(np.arange(len(row)), parts)
                other = np.arange(len(at)) - np.repeat(np.cumsum(parts) - parts, parts)
                mine = own[at]
                vectors = some["e"].take(pa.array(row[at]))
                arrays = [
                    pa.array(np.full(len(at), dim, np.int32)), pa.array(half[at]), pa.array(np.minimum(mine, other)), pa.array(np.maximum(mine, other)),
                    pa.array(mine), pa.array(node[row[at]]), some["n"].take(pa.array(row[at])), vectors,
                ]
                yield pa.RecordBatch.from_arrays(arrays, names)

    dealt = classes.select("node", "n", F.col("e")).mapInArrow(
        deal, f"d int, half long, low long, high long, own long, node long, n long, e {kind}"
    )
    place = ["d", "half", "low", "high"]

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        key = None
        for batch in batches:
            keys = np.stack([batch[c].to_numpy().astype(np.int64) for c in place], 1)
            cuts = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1), batch.num_rows]
            for a, b in zip(cuts, cuts[1:]):
                if a == b:
                    continue
                if tuple(keys[a]) != key:
                    yield from _compare(held, key, sizes, cosine)
                    held, key = [], tuple(keys[a])
                held.append(batch.slice(a, b - a))
        yield from _compare(held, key, sizes, cosine)

    return dealt.repartition(*place).sortWithinPartitions(*place).mapInArrow(compare, "node long, links long, other long")


def _compare(held: list[pa.RecordBatch], key: tuple | None, sizes: dict[int, int], cosine: float) -> Iterator[pa.RecordBatch]:
    if not held or (len(held) == 1 and held[0].num_rows == 1):
        return
    dim, half, low, high = map(int, key)
    table = pa.Table.from_batches(held).combine_chunks()
    node, n, own = (table[c].to_numpy() for c in ("node", "n", "own"))
    unit = _unit(table["e"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, dim))
    k = sizes[dim]
    row, filters = codes(dim, k).decode(unit)
    keys = np.unique(row * k + filters // k)  # every vector's first halves, ascending
    halves = keys % k
    width = np.bincount(keys // k, minlength=len(unit))
    begin = np.cumsum(width) - width

    def smallest_shared(i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """The smallest first half of each pair; all pairs here share this one."""
        found, open_, rank = np.full(len(i), half), np.arange(len(i)), 0
        while len(open_):
            open_ = open_[width[i[open_]] > rank]
            tried = halves[begin[i[open_]] + rank]
            open_, tried = open_[tried < half], tried[tried < half]
            wanted = j[open_] * k + tried
            hit = keys[np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)] == wanted
            found[open_[hit]] = tried[hit]
            open_, rank = open_[~hit], rank + 1
        return found

    links, unions = np.zeros(len(unit)), Unions(len(unit))
    left, right = np.flatnonzero(own == low), np.flatnonzero(own == high)
    for a in range(0, len(left), TILE):
        for b in range(a if low == high else 0, len(right), TILE):
            i, j = left[a : a + TILE], right[b : b + TILE]
            x, y = np.nonzero(unit[i] @ unit[j].T >= cosine)
            i, j = i[x], j[y]
            if low == high:
                i, j = i[i < j], j[i < j]
            if len(i):
                unions.add(i, j)
            mine = smallest_shared(i, j) == half
            links += np.bincount(i[mine], n[j[mine]], len(unit)) + np.bincount(j[mine], n[i[mine]], len(unit))
    joined = unions.roots != np.arange(len(unit))
    out = np.flatnonzero((links > 0) | joined)
    if len(out):
        other = pa.array(node[unions.roots[out]], mask=~joined[out])
        yield pa.RecordBatch.from_arrays([pa.array(node[out]), pa.array(links[out].astype(np.int64)), other], ["node", "links", "other"])


def near_vectors(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", cosine: float = COSINE, max_block: int = MAX_BLOCK) -> DataFrame:
    """(vec_id, n_links, component_id, kept), one row per vector."""
    e = F.col(embedding)
    finite = F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    valid = F.coalesce((F.size(e) > 0) & finite & F.exists(e, lambda x: x != 0), F.lit(False))
    marked = vectors.select(
        F.col(vec_id).alias("vec_id"),
        e.alias("e"),
        F.when(valid, F.xxhash64(e)).alias("h1"),
        F.when(valid, F.xxhash64(F.lit("second"), e)).alias("h2"),
    )
    grouped = marked.where("h1 is not null").groupBy("h1", "h2").agg(
        F.min("vec_id").alias("least"), F.count(F.lit(1)).alias("n"), F.first("e").alias("e")
    )
    classes = stored(grouped.withColumn("node", F.monotonically_increasing_id()), "vectors")
    found = stored(link_vectors(classes, cosine, max_block), "links")
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    roots = connected_components(found.where("other is not null"), "node", "other")
    labelled = (
        classes.select("node", "h1", "h2", "least", "n")
        .join(links, "node", "left")
        .join(roots, "node", "left")
        .withColumn("root", F.coalesce("component", "node"))
    )
    smallest = labelled.groupBy("root").agg(F.min("least").alias("component_id"))
    by_class = labelled.join(smallest, "root").select("h1", "h2", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("links"), "component_id")
    known = F.col("h1").isNotNull()
    return (
        marked.select("vec_id", "h1", "h2")
        .join(by_class, ["h1", "h2"], "left")
        .select(
            "vec_id",
            F.when(known, F.col("links")).otherwise(F.lit(0)).alias("n_links"),
            F.when(known, F.col("component_id")).otherwise(F.col("vec_id")).alias("component_id"),
        )
        .withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
    )
