"""Hard negatives: for every anchor and positive, the best rows of another label that score just below the positive.

Scores are exact integer inner products, computed by Kronecker packing: component d of thousands of
candidates goes into separated fields of one wide integer, biased so that no field is negative. One
multiplication by the anchor's component d then multiplies all of them, the sum over d holds every
candidate's inner product in its field, and the biases, known per row, are taken off again. Fields
are as wide as the largest sum that the block's own range allows, so nothing carries over.

Spark cuts anchors and candidates into blocks of bounded size, and a pair of blocks is one task: a
stated set of anchors against all rows. The first pass finds positives and meets only blocks of the
anchor's own label, a hot label being more blocks; the second meets all rows. What leaves a task is
a few rows per anchor, and the few best of all blocks are picked by a window.

Defined results: rows with a null label, a null vector, or a null or non-finite component take no
part; shorter vectors count as filled up with zeros, so an empty one scores 0; every row of repeated
rows is a candidate of its own, and an anchor of its own, but never its own positive; a null id is
no anchor and comes after all others in ties; an empty table gives an empty result. Columns besides
the id, the label and the vector are not read. Components so large that a score could leave 64 bits
raise an error: there is no right answer to return.
"""

from __future__ import annotations

from operator import mul

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from earshot.functions.hashing import spread
from earshot.operators.skew import lookup_join
from earshot.session import stored

SCALE = 256
POSITIVES = 5
NEGATIVES = 5
LEAST = (80, 100)  # a negative scores at least this share of its positive
ANCHOR_BLOCK = 4_096
ITEM_BLOCK = 8_192
FIELDS = 2_048  # candidates packed into one wide integer

FOUND = "anchor long, at long, place int, score long, id long, x long"


def quantised(vector: str, scale: int = SCALE) -> Column:
    """The vector's components as floor(scale * x), x as double."""
    return F.transform(F.col(vector).cast("array<double>"), lambda x: F.floor(x * F.lit(float(scale))))


def whole(vector: str) -> Column:
    """True for a vector that is not null and has finite components only."""
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    return F.col(vector).isNotNull() & ~F.exists(F.col(vector).cast("array<double>"), bad)


# ---- inside the tasks -------------------------------------------------------------------------


class Packed:
    """Candidates as wide integers, one per component and ``FIELDS`` rows."""

    def __init__(self, matrix: np.ndarray, most: np.ndarray):
        """``most`` is the largest biased anchor component per dimension."""
        self.bias = int(max(0, -matrix.min(initial=0)))
        biased = matrix + self.bias
        largest = sum(map(mul, most.tolist(), biased.max(0, initial=0).tolist()))
        self.width = 4 if largest < 1 << 32 else 8 if largest < 1 << 64 else 16
        self.sums = matrix.sum(1)
        self.rows = len(matrix)
        self.parts = []
        for start in range(0, self.rows, FIELDS):
            part = biased[start : start + FIELDS]
            fields = np.zeros((matrix.shape[1], len(part), self.width // 4), "<u4")
            fields[:, :, 0] = part.T & 0xFFFFFFFF
            if self.width > 4:
                fields[:, :, 1] = part.T >> 32
            self.parts.append((len(part), [int.from_bytes(row.tobytes(), "little") for row in fields]))

    def scores(self, anchor: np.ndarray, anchor_bias: int) -> np.ndarray:
        """Inner products of one anchor with every candidate."""
        factors = (anchor + anchor_bias).tolist()
        fields = np.empty(self.rows, np.uint64)
        start = 0
        for n, wide in self.parts:
            total = sum(map(mul, factors, wide))  # one multiplication per component
            raw = np.frombuffer(total.to_bytes(n * self.width, "little"), "<u4" if self.width == 4 else "<u8")
            fields[start : start + n] = raw if self.width <= 8 else raw[::2]
            start += n
        # Fields minus biases, modulo 2^64: right as the inner product itself fits 64 bits.
        off = np.uint64((self.bias * sum(factors)) % (1 << 64)) + self.sums.astype(np.uint64) * np.uint64(anchor_bias)
        return (fields - off).view(np.int64)


def _matrix(column: pa.ListArray, dims: int) -> np.ndarray:
    lengths = np.diff(column.offsets.to_numpy())
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64, copy=False)
    if len(lengths) and lengths.min() == dims:
        return values.reshape(len(lengths), dims)
    out = np.zeros((len(lengths), dims), np.int64)
    row = np.repeat(np.arange(len(lengths)), lengths)
    out[row, np.arange(len(values)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = values
    return out


def _sides(left: pa.Table, right: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    columns = [t.column("vec").combine_chunks() for t in (left, right)]
    dims = max(int(np.diff(c.offsets.to_numpy()).max(initial=0)) for c in columns)
    anchors, items = (_matrix(c, dims) for c in columns)
    largest = [np.abs(m).max(0, initial=0).astype(object) for m in (anchors, items)]
    if dims and sum(largest[0] * largest[1]) >= 1 << 63:
        raise ValueError("components are too large: an inner product could leave 64 bits")
    return anchors, items


def _ids(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    column = table.column("id").combine_chunks()
    return column.fill_null(0).to_numpy(), column.is_null().to_numpy(zero_copy_only=False)


def _block(left: pa.Table, right: pa.Table, pick) -> pa.Table:
    """Rows that ``pick`` keeps of every anchor's scores, as FOUND."""
    kept = []
    if left.num_rows and right.num_rows:
        anchors, items = _sides(left, right)
        bias = int(max(0, -anchors.min(initial=0)))
        packed = Packed(items, (anchors + bias).max(0, initial=0))
        ids, null = _ids(right)
        own = _ids(left)[0]
        rows = right.column("row").to_numpy()
        at = left.column("row").to_numpy()
        for i, anchor in enumerate(anchors):
            score = packed.scores(anchor, bias)
            for place, chosen in pick(i, score, rows, ids, null):
                n = len(chosen)
                kept.append((np.full(n, own[i]), np.full(n, at[i]), np.full(n, place), score[chosen], ids[chosen], null[chosen], rows[chosen]))
    columns = [np.concatenate(c) for c in zip(*kept)] if kept else [np.zeros(0, np.int64)] * 5 + [np.zeros(0, bool), np.zeros(0, np.int64)]
    anchor, at, place, score, found, null, x = columns
    return pa.table([
        pa.array(anchor), pa.array(at), pa.array(place.astype(np.int32)), pa.array(score), pa.array(found, mask=null), pa.array(x)
    ], names=["anchor", "at", "place", "score", "id", "x"])


def _order(score, rows, ids, null):
    return np.lexsort((rows, ids, null, -score))


def _positives(left: pa.Table, right: pa.Table, n: int) -> pa.Table:
    """The first ``n`` rows of each anchor, itself left out; all rows have its label."""
    at = left.column("row").to_numpy() if left.num_rows else None

    def pick(i, score, rows, ids, null):
        other = rows != at[i]
        near = np.flatnonzero(other)
        if len(near) > n:
            near = near[score[near] >= np.partition(score[near], len(near) - n)[len(near) - n]]
        yield 0, near[_order(score[near], rows[near], ids[near], null[near])][:n]

    return _block(left, right, pick)


def _negatives(left: pa.Table, right: pa.Table, n: int, least: tuple[int, int]) -> pa.Table:
    """The first ``n`` rows in the range of each positive of each anchor, of other labels."""
    low, base = least
    labels = right.column("label").to_numpy() if right.num_rows else None
    own = left.column("label").to_numpy() if left.num_rows else None
    wanted = left.column("positives").to_pylist() if left.num_rows else []

    def pick(i, score, rows, ids, null):
        tops = [p for p in wanted[i] if p >= 0]  # below zero the range is empty
        if not tops:
            return
        bottoms = [-(-low * p // base) for p in tops]
        near = np.flatnonzero((score <= max(tops)) & (score >= min(bottoms)) & (labels != own[i]))
        near = near[_order(score[near], rows[near], ids[near], null[near])]
        falling = -score[near]
        for place, p in enumerate(wanted[i]):
            if p >= 0:
                first = np.searchsorted(falling, -p)
                last = np.searchsorted(falling, low * p // -base, "right")  # -ceil(low * p / base)
                yield place, near[first : min(last, first + n)]

    return _block(left, right, pick)


# ---- the plan ---------------------------------------------------------------------------------


def _every(blocks: Column) -> Column:
    return F.explode(F.sequence(F.lit(0), blocks.cast("int") - 1))


def _paired(anchors: DataFrame, items: DataFrame, key: list[str], score) -> DataFrame:
    """``score`` of every (anchor block, item block); both sides carry their counts of blocks."""
    a = anchors.withColumns({"ab": spread(F.col("a_blocks"), "row"), "xb": _every(F.col("x_blocks"))})
    x = items.withColumns({"xb": spread(F.col("x_blocks"), "row"), "ab": _every(F.col("a_blocks"))})
    key = [*key, "ab", "xb"]
    counts = ["a_blocks", "x_blocks"]
    return a.drop(*counts).groupBy(*key).cogroup(x.drop(*counts).groupBy(*key)).applyInArrow(score, FOUND)


def _first(found: DataFrame, by: list[str], n: int) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.desc("score"), F.col("id").asc_nulls_last(), "x")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)


def _blocks(n: Column, size: int) -> Column:
    return F.greatest(F.ceil(n / size), F.lit(1))


def mine(
    vectors: DataFrame,
    anchors: Column,
    id: str = "vec_id",
    vector: str = "embedding",
    label: str | Column = "label",
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    least: tuple[int, int] = LEAST,
    scale: int = SCALE,
    anchor_block: int = ANCHOR_BLOCK,
    item_block: int = ITEM_BLOCK,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score), rank from 1.

    ``anchors`` tells which rows are anchors. Their positives are the first ``positives`` other
    rows of their label, by score and then by id; the negatives of a positive are the first
    ``negatives`` rows of other labels whose score is at most the positive's and at least
    ``least[0] / least[1]`` of it.
    """
    labelled = F.col(label) if isinstance(label, str) else label
    rows = vectors.where(labelled.isNotNull() & whole(vector)).select(
        F.col(id).cast("long").alias("id"),
        labelled.alias("label"),
        F.coalesce(anchors, F.lit(False)).alias("asks"),
        quantised(vector, scale).alias("vec"),
        F.monotonically_increasing_id().alias("row"),  # holds once written
    )
    rows = stored(rows, "quantised")
    asking = stored(rows.where("asks").drop("asks"), "anchors")
    rows = rows.drop("asks")

    n = F.count(F.lit(1))
    sizes = asking.groupBy("label").agg(n.alias("a")).join(rows.groupBy("label").agg(n.alias("x")), "label")
    sizes = sizes.select("label", _blocks(F.col("a"), anchor_block).alias("a_blocks"), _blocks(F.col("x"), item_block).alias("x_blocks"))
    found = _paired(
        lookup_join(asking, sizes, "label"), lookup_join(rows, sizes, "label"), ["label"], lambda a, x: _positives(a, x, positives)
    )
    best = stored(_first(found, ["at"], positives), "positives")

    lists = best.groupBy("at").agg(F.array_sort(F.collect_list(F.struct("rank", "score"))).alias("p"))  # ``positives`` a row at most
    asking = stored(asking.join(lists.select(F.col("at").alias("row"), F.col("p.score").alias("positives")), "row"), "asking")
    total = rows.agg(n).first()[0]
    asked = asking.count()
    counts = {"a_blocks": F.lit(-(-asked // anchor_block) or 1), "x_blocks": F.lit(-(-total // item_block) or 1)}
    found = _paired(asking.withColumns(counts), rows.withColumns(counts), [], lambda a, x: _negatives(a, x, negatives, least))
    ranked = _first(found, ["at", "place"], negatives)
    of = best.select("at", (F.col("rank") - 1).alias("place"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    return ranked.join(of, ["at", "place"]).select(
        F.col("anchor").alias("anchor_id"), "positive_id", "rank", F.col("id").alias("negative_id"),
        "positive_score", F.col("score").alias("negative_score"),
    )
