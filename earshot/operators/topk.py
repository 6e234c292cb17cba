"""Exact top-k partners of every query vector, by dot product or squared Euclidean distance.

One operator serves recommendation (user factor against item factors), exact neighbour search
and, with a ``cell`` column on both sides, search inside the cells of an approximate index.

Spark moves the vectors and NumPy scores whole blocks inside the tasks. The layout follows the
counted size of the two sides:

``items``    the items fit a broadcast: queries are scored where they are, nothing is shuffled
             (not if the queries and their k rows are fewer than the items)
``queries``  the queries fit a broadcast: items are scored where they are, each task keeps its
             own k best per query, and one shuffle merges them
``grid``     neither fits: with cells, both sides are cut into blocks of bounded size and every block
             pair is one task, so a cell that holds most of the rows is still split evenly; without,
             the queries are cut into blocks, and the items stream past each of them while it holds
             its k best, so that nothing but these leaves a task

No layout materialises pairs: what leaves a task is at most k rows per query. Scores of the
survivors are recomputed term by term in dimension order, so the result (ties by item id) does
not depend on block sizes or on the BLAS in use.
"""

from __future__ import annotations

import sys
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from earshot.functions.hashing import spread
from earshot.operators.indexing import number_rows
from earshot.operators.skew import lookup_join
from earshot.session import stored

# Task code below is shipped with the plan, so executors need no installed copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

MAX_SIDE_BYTES = 32 << 20  # largest side that is broadcast; every Python worker holds it about four times
MAX_HELD_ROWS = 4_000_000  # queries * k that one task may hold in the ``queries`` layout
MOST_MOVED = 1 << 30  # bytes of items that are moved to blocks of queries; beyond, tasks read them from where they are stored
MOST_PIECES = 8  # broadcasts that the queries may take for that
QUERY_BLOCK = 8_192
LEAST_QUERY_BLOCK = 256  # blocks are cut down to this while there are cores without one
ITEM_BLOCK = 65_536
SCORE_CELLS = 4 << 20  # scores in memory at a time
PAIRS_PER_TASK = 10_000_000
MIN_ROWS_PER_TASK = 1000  # below this, loading the broadcast side costs more than scoring
FIRST_ITEMS = 4_096  # items that a block of queries meets before the others
MASK_BITS = 32_768  # items of a block whose seen ones are a bitmap, as Spark's bitmap functions cut them
MASKED_QUERIES = 1_024  # queries of a block that carry bitmaps: at most 4 MB of them


def top_k(
    queries: DataFrame,
    items: DataFrame,
    k: int | str,
    metric: str,
    query_id: str = "query_id",
    item_id: str = "id",
    vector: str = "features",
    cell: str | None = None,
    layout: str | None = None,
) -> DataFrame:
    """(query_id, item_id, score, rank) with rank 1..k per query, ties by item id.

    ``metric`` is ``dot`` (largest first) or ``l2`` (smallest squared distance first). ``k`` is a
    number or an integer column of ``queries``. With ``cell``, a query meets only the items that
    share a cell with it; both sides may list a vector under several cells, a pair counts once.
    """
    if metric not in ("dot", "l2"):
        raise ValueError(f"unknown metric {metric!r}")
    own_k = isinstance(k, str)
    cells = F.col(cell).cast("string") if cell else F.lit("")
    limit = F.col(k).cast("int") if own_k else F.lit(k)
    vec = _vec(vector)
    q = queries.select(F.col(query_id).cast("bigint").alias("q"), limit.alias("k"), cells.alias("cell"), vec)
    x = items.select(F.col(item_id).cast("bigint").alias("x"), cells.alias("cell"), vec)
    n_q, n_x = q.count(), x.count()
    layout = layout or _layout(q, x, n_q, n_x, k)

    if layout == "items":
        found = _scan(_spread_work(q, n_q, n_x), x, metric, broadcast_queries=False, has_cells=bool(cell))
    elif layout == "queries":
        found = _scan(_spread_work(x, n_x, n_q), q, metric, broadcast_queries=True, has_cells=bool(cell))
    else:
        found, merged = _grid(q, x, n_q, n_x, metric) if cell else _stream_all(q, x, n_q, metric, n_x)

    if cell or layout == "queries" or (layout == "grid" and not merged):
        best = Window.partitionBy("q").orderBy("cost", "x")
        found = found.withColumn("rank", F.dense_rank().over(best))  # copies of a pair rank alike
    found = found.where(F.col("rank") <= (F.col("k") if own_k else F.lit(k)))
    if cell:  # partitioned by q already, so this does not shuffle again
        found = found.groupBy("q", "x").agg(F.first("cost").alias("cost"), F.first("rank").alias("rank"))
    score = -F.col("cost") if metric == "dot" else F.col("cost")
    return found.select(
        F.col("q").alias(query_id), F.col("x").alias(item_id), score.alias("score"), "rank"
    )


def top_k_unseen(
    queries: DataFrame,
    items: DataFrame,
    seen: DataFrame,
    k: int,
    metric: str,
    query_id: str = "query_id",
    item_id: str = "id",
    vector: str = "features",
) -> DataFrame:
    """(query_id, item_id, score, rank) as ``top_k``, without the pairs of ``seen`` (query_id, item_id).

    Items stream past blocks of queries in the order of their numbers, and a query brings words of 64 items with
    what it has seen. The task masks these before it chooses, so it returns at most k rows a query
    however much the query has seen. Ids are unique on either side; pairs that name an unknown query
    or item, and repeated pairs, change nothing.
    """
    if metric not in ("dot", "l2"):
        raise ValueError(f"unknown metric {metric!r}")
    vec = _vec(vector)
    q = queries.select(F.col(query_id).cast("bigint").alias("q"), F.lit(k).alias("k"), vec)
    x = items.select(F.col(item_id).cast("bigint").alias("x"), vec)
    pairs = seen.select(F.col(query_id).cast("bigint").alias("q"), F.col(item_id).cast("bigint").alias("x"))
    n_x, least, last = x.agg(F.count(F.lit(1)), F.min("x"), F.max("x")).first()
    if n_x and (least < 0 or last >= 4 * n_x):  # sparse ids would make more blocks than items need
        numbers = number_rows(x.select("x").orderBy("x"), "number", "numbers").select("x", F.col("number").cast("bigint").alias("number"))
        x, pairs, last = x.join(numbers, "x"), lookup_join(pairs, numbers, "x"), n_x - 1
    else:
        x, pairs = x.withColumn("number", F.col("x")), pairs.where(F.col("x") >= 0).withColumn("number", F.col("x"))
    at = F.col("number") + 1  # the bitmap functions count from one
    pairs = pairs.where(F.col("number") <= F.lit(last or 0))
    # Words of 64 items with a bit set, so a pair costs some bytes whatever a block holds; the task makes bitmaps.
    pairs = pairs.join(q.select("q"), "q", "left_semi").withColumns({"xb": (F.bitmap_bucket_number(at) - 1).cast("int"), "bit": F.bitmap_bit_position(at)})
    word = (F.col("bit") / 64).cast("int").alias("word")
    words = pairs.groupBy("q", "xb", word).agg(F.bit_or(F.expr("shiftleft(1L, cast(bit % 64 as int))")).alias("bits"))
    words = words.groupBy("q", "xb").agg(F.collect_list(F.struct("word", "bits")).alias("words"))  # at most MASK_BITS / 64
    words = stored(words.groupBy("q").agg(F.collect_list(F.struct("xb", "words")).alias("seen")), "seen")
    n_q, n_words = q.count(), words.agg(F.sum(F.aggregate("seen", F.lit(0), lambda n, s: n + F.size(s["words"])))).first()[0] or 0
    q = q.join(words, "q", "left").select(F.col("q").alias("id"), "k", F.lit(0.0).alias("reach"), "vec", "seen")
    x = x.select(F.col("x").alias("id"), F.col("number").cast("bigint").alias("cell"), "vec")
    found, merged = stream(q, x, n_q, k + -(-n_words // max(n_q, 1)), lambda table: _Unseen(table, metric), "seen")
    if not merged:
        found = found.withColumn("rank", F.row_number().over(Window.partitionBy("q").orderBy("cost", "x"))).where(F.col("rank") <= k)
    cost = -F.col("cost") if metric == "dot" else F.col("cost")
    return found.select(F.col("q").alias(query_id), F.col("x").alias(item_id), cost.alias("score"), "rank")


def nearest(rows: DataFrame, centres: DataFrame, cell: str = "cell", vector: str = "features") -> DataFrame | None:
    """``rows`` with the ``cell`` of the nearest centre, lowest cell on ties; None if there are too many centres.

    The centres are broadcast and every row keeps its place, so nothing is shuffled or joined.
    """
    x = centres.select(F.col(cell).cast("bigint").alias("x"), F.lit("").alias("cell"), _vec(vector))
    if x.count() * _row_bytes(x) > MAX_SIDE_BYTES:
        return None
    held = _broadcast(x)
    names = rows.columns

    def assign(batches):
        known = _by_cell(held.value)
        for batch in batches:
            n = batch.num_rows
            matrix = _matrix(batch.column(names.index(vector)))
            asked = {"": (np.arange(n), np.ones(n, dtype=np.int32), matrix)}
            found = [part[2] for part in _search(asked, known, "l2")] if n else []
            if found:  # one centre per row, in row order
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.concatenate(found))], [*names, cell])

    schema = T.StructType([*rows.schema.fields, T.StructField(cell, T.LongType())])
    return rows.mapInArrow(assign, schema)


def _vec(vector: str):
    return F.col(vector).cast("array<double>").alias("vec")


def _row_bytes(side: DataFrame) -> int:
    first = side.select(F.size("vec")).first()
    return 8 * ((first[0] if first else 0) + 4)


def _broadcast(side: DataFrame):
    """A side of checked size as one Arrow table on every executor."""
    return side.sparkSession.sparkContext.broadcast(side.toArrow().combine_chunks())


def _layout(q: DataFrame, x: DataFrame, n_q: int, n_x: int, k: int | str) -> str:
    if not n_q or not n_x:
        return "grid"
    row_bytes = _row_bytes(x)
    largest_k = q.agg(F.max("k")).first()[0] if isinstance(k, str) else k
    few = n_q * row_bytes <= MAX_SIDE_BYTES and n_q * largest_k <= MAX_HELD_ROWS
    if few and n_q * (largest_k + 1) < n_x:  # a broadcast of the items would be the larger one
        return "queries"
    if n_x * row_bytes <= MAX_SIDE_BYTES:
        return "items"
    return "queries" if few else "grid"


FOUND = "q bigint, k int, x bigint, cost double, rank int"


def _spread_work(side: DataFrame, n_rows: int, n_other: int) -> DataFrame:
    """Few file splits can still mean much scoring: cut the scanned side by the number of pairs.

    Partitioning by id keeps the rows of a query, one per cell it visits, in one task.
    """
    tasks = n_rows // max(MIN_ROWS_PER_TASK, PAIRS_PER_TASK // max(n_other, 1))
    return side.repartition(tasks, side.columns[0]) if tasks > 1 else side


def _scan(side: DataFrame, small: DataFrame, metric: str, broadcast_queries: bool, has_cells: bool) -> DataFrame:
    """Score ``side`` where it lies against ``small``, whose size ``_layout`` has checked."""
    held = _broadcast(small)
    if has_cells:
        side = side.join(F.broadcast(small.select("cell").distinct()), "cell", "left_semi")

    def score(batches):
        other = _by_cell(held.value)
        if not broadcast_queries:
            for batch in batches:
                found = _search(_by_cell(pa.Table.from_batches([batch])), other, metric)
                yield from _emit([_best(found)] if has_cells else found)
            return
        kept = None
        for batch in batches:
            found = _search(other, _by_cell(pa.Table.from_batches([batch])), metric)
            kept = _best(found if kept is None else [kept, *found])
        yield from _emit([kept])

    return side.mapInArrow(score, FOUND)


def top_k_sharing(queries: DataFrame, items: DataFrame, k: int, n_q: int, keys: int) -> DataFrame:
    """(query_id, id, score, rank) by squared distance of the items that share one of a query's ``keys`` keys.

    Both sides are (id, features) whose last ``keys`` values are the keys, by place. Every pair is scored, the
    keys are compared only of pairs that could enter a list: for keys that so many pairs share that listing
    both sides under each key would be more work.
    """
    q = queries.select("id", F.lit(k).alias("k"), F.lit(0.0).alias("reach"), F.col("features").alias("vec"))
    x = items.select("id", F.lit(0).cast("bigint").alias("cell"), F.col("features").alias("vec"))
    found, merged = stream(q, x, n_q, k, lambda table: _Sharing(table, keys))
    if not merged:
        best = Window.partitionBy("q").orderBy("cost", "x")
        found = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return found.select(F.col("q").alias("query_id"), F.col("x").alias("id"), F.col("cost").alias("score"), "rank")


def _stream_all(q: DataFrame, x: DataFrame, n_q: int, metric: str, n_x: int = 0) -> tuple[DataFrame, bool]:
    largest_k = max(q.agg(F.max("k")).first()[0] or 1, 1)
    row_bytes = _row_bytes(q)
    q = q.select(F.col("q").alias("id"), "k", F.lit(0.0).alias("reach"), "vec")
    x = x.select(F.col("x").alias("id"), F.lit(0).cast("bigint").alias("cell"), "vec")
    moved = -(-n_q // _block_rows(largest_k)) * n_x * row_bytes
    if moved > MOST_MOVED and n_q * row_bytes <= MOST_PIECES * MAX_SIDE_BYTES:
        return _stream_scanned(q, x, n_q, largest_k, row_bytes, lambda queries: _Running(queries, metric))
    return stream(q, x, n_q, largest_k, lambda queries: _Running(queries, metric))


def _layers(q: DataFrame, n_q: int, k: int) -> tuple[int, int]:
    """Blocks of queries, and parts of the items for each, that give every core work."""
    tasks = 2 * q.sparkSession.sparkContext.defaultParallelism
    rows = _block_rows(k)
    q_blocks = max(-(-n_q // rows), min(-(-n_q // min(LEAST_QUERY_BLOCK, rows)), tasks)) or 1
    return q_blocks, -(-tasks // q_blocks)


def _block_rows(k: int) -> int:
    """Queries of a block, each of which holds ``k`` rows."""
    return max(1, min(2 * QUERY_BLOCK, MAX_HELD_ROWS // k))


def _stream_scanned(q: DataFrame, x: DataFrame, n_q: int, k: int, row_bytes: int, start: Callable) -> tuple[DataFrame, bool]:
    """As ``stream``, but a task reads the items from where they are stored, so that nothing is moved or left on a disk.

    Blocks of queries are broadcast, in pieces of at most a broadcast side each.
    """
    spark = q.sparkSession
    q_blocks, parts = _layers(q, n_q, k)
    q, x = stored(q.withColumn("block", spread(q_blocks, "id")), "stream-queries"), stored(x, "stream-items")
    step = max(1, MAX_SIDE_BYTES // (-(-n_q // q_blocks) * row_bytes))
    found = None
    for first in range(0, q_blocks, step):
        last = min(first + step, q_blocks)
        run = _scanning(_broadcast(q.where((F.col("block") >= first) & (F.col("block") < last))), start)
        blocks = spark.range(first, last, 1, last - first).withColumnRenamed("id", "block")  # one partition each
        both = x.coalesce(parts).hint("shuffle_replicate_nl").crossJoin(blocks)  # every block with every part of the items
        piece = both.select("id", "cell", "vec", "block").mapInArrow(run, FOUND)
        found = piece if found is None else found.unionByName(piece)
    return found, parts == 1


def _scanning(sent, start: Callable) -> Callable:
    def run(batches):
        state, held, n = None, [], 0
        for batch in batches:
            if not batch.num_rows:
                continue
            if state is None:
                own = sent.value.filter(pc.equal(sent.value.column("block"), batch.column(3)[0])).combine_chunks()
                if not own.num_rows:
                    return
                state = start(own)
            held.append(batch)
            n += batch.num_rows
            if n >= ITEM_BLOCK:
                state.meet(pa.Table.from_batches(held).combine_chunks())
                held, n = [], 0
        if held:
            state.meet(pa.Table.from_batches(held).combine_chunks())
        if state is not None:
            yield from state.found()

    return run


def stream(q: DataFrame, x: DataFrame, n_q: int, k: int, start: Callable, *more: str) -> tuple[DataFrame, bool]:
    """(found rows, whether they are complete): blocks of queries that all items stream past.

    ``q`` is (id, k, reach, vec) and ``x`` (id, cell, vec); items come by cell. ``more`` are further columns
    of ``q``, and ``k`` is what a query holds, in rows. ``start`` makes the state of a block from the table of its queries: ``meet`` takes a table of items,
    ``found`` gives the result. Items move once per block, so blocks are as large as the k rows a
    query holds allow; while cores are left over, items are dealt to several tasks as well, whose
    rows are to be merged.
    """
    q_blocks, parts = _layers(q, n_q, k)

    def every(n: int, step: int = 1):
        return F.explode(F.array(*[F.lit(i * step) for i in range(n)]))

    asked = q
    q = asked.select(
        "id", "k", "reach", F.lit(-1).cast("bigint").alias("cell"), "vec", F.lit(0).alias("side"),
        (spread(q_blocks, "id") * parts).alias("first"), every(parts).alias("at"), *more,
    )
    x = x.select(
        "id", F.lit(0).alias("k"), F.lit(0.0).alias("reach"), "cell", "vec", F.lit(1).alias("side"),
        spread(parts, "id").alias("first"), every(q_blocks, parts).alias("at"), *[F.lit(None).cast(asked.schema[c].dataType).alias(c) for c in more],
    )
    both = q.unionByName(x).withColumn("task", F.col("first") + F.col("at")).drop("first", "at")
    both = both.repartitionById(q_blocks * parts, F.col("task")).sortWithinPartitions("task", "side", "cell")

    def run(batches):
        task, state, held, n = None, None, [], 0  # ``held``: rows of one task and side, not yet met
        for batch in batches:
            keys = 2 * batch.column(6).to_numpy().astype(np.int64) + batch.column(5).to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(keys)) + 1).tolist(), len(keys)]
            for a, b in zip(cuts[:-1], cuts[1:]):
                if b == a:
                    continue
                if keys[a] != task:
                    if held:
                        state = _next(state, task, held, start)
                    if state is not None and keys[a] >> 1 != task >> 1:
                        yield from state.found()
                        state = None
                    task, held, n = int(keys[a]), [], 0
                held.append(batch.slice(a, b - a))
                n += b - a
                if task & 1 and n >= ITEM_BLOCK:
                    state, held, n = _next(state, task, held, start), [], 0
        if held:
            state = _next(state, task, held, start)
        if state is not None:
            yield from state.found()

    return both.select("id", "k", "reach", "cell", "vec", "side", "task", *more).mapInArrow(run, FOUND), parts == 1


def _next(state, key: int, held: list, start: Callable):
    """The state of a task after a table of its queries (an even ``key``) or its items."""
    table = pa.Table.from_batches(held).combine_chunks()
    if not key & 1:
        return start(table)
    if state is not None:  # else no query fell into the block
        state.meet(table)
    return state


class _Running:
    """The k best items of a block of queries, in parts that are scored together."""

    def __init__(self, queries: pa.Table, metric: str):
        self.metric, self.begun = metric, 0
        ids, k, matrix = queries.column("id").to_numpy(), queries.column("k").to_numpy(), _matrix(queries.column("vec").combine_chunks())
        step = max(1, SCORE_CELLS // (2 * ITEM_BLOCK))
        order = np.argsort(ids, kind="stable")
        order = order[k[order] > 0]
        self.parts = [[ids[at], k[at], matrix[at], None, np.full(len(at), np.inf)] for at in (order[i : i + step] for i in range(0, len(order), step))]

    def meet(self, items: pa.Table) -> None:
        limit = max(FIRST_ITEMS, 4 * self.begun)  # a few items set the scores to beat, so that lists of all need not be cut
        while items.num_rows > limit:
            self.meet(items.slice(0, limit).combine_chunks())
            items, limit = items.slice(limit).combine_chunks(), 4 * self.begun
        self.begun += items.num_rows
        x_ids, x_mat = items.column("id").to_numpy(), _matrix(items.column("vec").combine_chunks())
        squares = self._squares(x_mat)
        by_dim = np.ascontiguousarray(x_mat.T)
        for part in self.parts:
            ids, kept, bar = part[0], part[3], part[4]
            found = self._score(part, x_ids, x_mat, by_dim, squares)
            if len(found[0]):
                both = found if kept is None else [np.concatenate(c) for c in zip(kept, found)]
                part[3] = _ranked(*both[:4])
                last = part[3][4] == part[3][1]
                bar[np.searchsorted(ids, part[3][0][last])] = part[3][3][last]

    def _score(self, part: list, x_ids: np.ndarray, x_mat: np.ndarray, by_dim: np.ndarray, squares: np.ndarray):
        ids, k, matrix, _, bar = part
        return _score_block(ids, k, matrix, x_ids, by_dim, squares, self.metric, bar=bar)

    def _squares(self, x_mat: np.ndarray) -> np.ndarray:
        return np.einsum("ij,ij->i", x_mat, x_mat)

    def found(self):
        for part in self.parts:
            yield from _emit([part[3]])


class _Sharing(_Running):
    """As ``_Running`` by squared distance, of the items that share a key with the query."""

    def __init__(self, queries: pa.Table, keys: int):
        super().__init__(queries, "l2")
        self.parts = [[ids, k, matrix[:, :-keys], kept, bar, matrix[:, -keys:]] for ids, k, matrix, kept, bar in self.parts]
        self.keys = keys

    def _score(self, part: list, x_ids: np.ndarray, x_mat: np.ndarray, by_dim: np.ndarray, squares: np.ndarray):
        ids, k, matrix, _, bar, own = part
        theirs = x_mat[:, -self.keys :]
        masked = None
        if not np.isfinite(bar).all():  # no score to beat yet, so it must come from items that share a key
            masked = np.ones((len(ids), len(x_ids)), bool)
            for mine, other in zip(own.T, theirs.T):
                masked &= mine[:, None] != other
        return _score_block(ids, k, matrix, x_ids, by_dim[: -self.keys], squares, self.metric, masked, bar, (own, theirs))

    def _squares(self, x_mat: np.ndarray) -> np.ndarray:
        return super()._squares(x_mat[:, : -self.keys])


class _Unseen:
    """The k best items of a block of queries that they have not seen. Items come by number, which is their ``cell``."""

    def __init__(self, queries: pa.Table, metric: str):
        self.metric, self.parts = metric, []
        order = np.argsort(queries.column("id").to_numpy(), kind="stable")
        for start in range(0, len(order), MASKED_QUERIES):
            own = queries.take(pa.array(order[start : start + MASKED_QUERIES])).combine_chunks()
            seen = own.column("seen").combine_chunks()
            entries = seen.flatten()
            at = np.repeat(np.arange(len(seen)), np.nan_to_num(pc.list_value_length(seen).to_numpy(zero_copy_only=False)).astype(np.int64))
            table = pa.table({"q": own.column("id"), "k": own.column("k"), "vec": own.column("vec")})
            self.parts.append([table, at, entries.field("xb").to_numpy(), entries.field("words"), None, np.full(len(seen), np.inf)])

    def meet(self, items: pa.Table) -> None:
        number = items.column("cell").to_numpy()
        block = number // MASK_BITS
        cuts = [0, *(np.flatnonzero(np.diff(block)) + 1).tolist(), len(block)]
        for a, b in zip(cuts[:-1], cuts[1:]):
            some = items.slice(a, b - a)
            right = pa.table({"x": some.column("id"), "bit": pa.array(number[a:b] % MASK_BITS), "vec": some.column("vec")})
            for part in self.parts:
                self._meet(part, int(block[a]), right)

    def _meet(self, part: list, block: int, right: pa.Table) -> None:
        table, at, blocks, words, kept, bar = part
        here = np.flatnonzero(blocks == block)
        place = np.full(table.num_rows, -1)
        place[at[here]] = here
        left = _with_masks(table.append_column("words", words.take(pa.array(place, mask=place < 0))))
        found = [f for f in _search_unseen(left, right, self.metric, bar) if len(f[0])]
        if found:
            part[4] = kept = _ranked(*(np.concatenate(c) for c in zip(*(f[:4] for f in ([kept, *found] if kept is not None else found)))))
            last = kept[4] == kept[1]
            bar[np.searchsorted(table.column("q").to_numpy(), kept[0][last])] = kept[3][last]

    def found(self):
        for part in self.parts:
            yield from _emit([part[4]])


def _grid(q: DataFrame, x: DataFrame, n_q: int, n_x: int, metric: str) -> tuple[DataFrame, bool]:
    """Every (query block, item block) of a cell is one group of bounded size."""
    counted = F.count(F.lit(1))
    sizes = q.groupBy("cell").agg(counted.alias("q_rows")).join(
        x.groupBy("cell").agg(counted.alias("x_rows")), "cell"
    )
    blocks = sizes.select(
        "cell",
        F.ceil(F.col("q_rows") / QUERY_BLOCK).alias("q_blocks"),
        F.ceil(F.col("x_rows") / ITEM_BLOCK).alias("x_blocks"),
    )
    q = lookup_join(q, blocks, "cell")
    x = lookup_join(x, blocks, "cell")

    def every(n: str):
        return F.explode(F.sequence(F.lit(0), F.col(n).cast("int") - 1))

    q = q.withColumns({"qb": spread(F.col("q_blocks"), "q"), "xb": every("x_blocks")})
    x = x.withColumns({"xb": spread(F.col("x_blocks"), "x"), "qb": every("q_blocks")})
    key = ["cell", "qb", "xb"]

    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        found = _search(_by_cell(left), _by_cell(right), metric)  # every query is in one part
        return pa.concat_tables([_table(None), *map(_table, found)])

    drop = ["q_blocks", "x_blocks"]
    found = q.drop(*drop).groupBy(*key).cogroup(x.drop(*drop).groupBy(*key)).applyInArrow(score, FOUND)
    return found, False


# ---- inside the tasks -------------------------------------------------------------------------


def _by_cell(table: pa.Table) -> dict:
    """cell -> (ids, k, matrix); ``k`` is None for the item side."""
    if not table.num_rows:
        return {}
    table = table.combine_chunks()
    matrix = _matrix(table.column("vec").combine_chunks())
    is_query = "q" in table.column_names
    ids = table.column("q" if is_query else "x").to_numpy()
    k = table.column("k").to_numpy() if is_query else None
    cells = table.column("cell").combine_chunks().dictionary_encode()
    codes, names = cells.indices.to_numpy(), cells.dictionary.to_pylist()
    if len(names) == 1:
        return {names[0]: (ids, k, matrix)}
    order = np.argsort(codes, kind="stable")
    bounds = np.searchsorted(codes[order], np.arange(len(names) + 1))
    parts = {}
    for code, name in enumerate(names):
        rows = order[bounds[code] : bounds[code + 1]]
        parts[name] = (ids[rows], k[rows] if is_query else None, matrix[rows])
    return parts


def _matrix(column: pa.ListArray) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.astype(np.float64, copy=False).reshape(len(column), -1)


def _search(queries: dict, items: dict, metric: str):
    """(query ids, k, item ids, costs, ranks) for every cell both sides share."""
    for name, (q_ids, q_k, q_mat) in queries.items():
        if name not in items:
            continue
        x_ids, _, x_mat = items[name]
        squares = np.einsum("ij,ij->i", x_mat, x_mat)
        by_dim = np.ascontiguousarray(x_mat.T)
        step = max(1, SCORE_CELLS // len(x_ids))
        for start in range(0, len(q_ids), step):
            part = slice(start, start + step)
            yield _score_block(q_ids[part], q_k[part], q_mat[part], x_ids, by_dim, squares, metric)


def _with_masks(left: pa.Table) -> pa.Table:
    """``words`` (word, bits) of the seen items of a block as one bitmap per query, null for none."""
    masks = []
    for row in left.column("words").combine_chunks():
        mask = None
        if row.is_valid:
            word, bits = row.values.field("word"), row.values.field("bits")
            full = np.zeros(MASK_BITS // 64, "<i8")
            full[word.to_numpy()] = bits.to_numpy()
            mask = full.tobytes()
        masks.append(mask)
    return left.drop_columns(["words"]).append_column("mask", pa.array(masks, pa.binary()))


def _search_unseen(left: pa.Table, right: pa.Table, metric: str, bar: np.ndarray | None = None):
    """As ``_search`` for one block of queries and one of items, without the items in a query's bitmap; ``bar`` as in ``_score_block``."""
    if not left.num_rows or not right.num_rows:
        return
    left, right = left.combine_chunks(), right.combine_chunks()
    bits = right.column("bit").to_numpy()
    empty = bytes(MASK_BITS // 8)
    masks = left.column("mask").to_pylist()
    at = slice(bits[0], bits[-1] + 1) if (np.diff(bits) == 1).all() else bits  # of dense numbers a slice, which is no copy
    q_ids, q_k, q_mat = left.column("q").to_numpy(), left.column("k").to_numpy(), _matrix(left.column("vec").combine_chunks())
    x_ids, x_mat = right.column("x").to_numpy(), _matrix(right.column("vec").combine_chunks())
    squares = np.einsum("ij,ij->i", x_mat, x_mat)
    by_dim = np.ascontiguousarray(x_mat.T)
    step = max(1, SCORE_CELLS // max(len(x_ids), MASK_BITS))
    for start in range(0, len(q_ids), step):
        part = slice(start, start + step)
        masked = None
        if any(masks[part]):
            packed = np.frombuffer(b"".join(m or empty for m in masks[part]), np.uint8).reshape(-1, MASK_BITS // 8)
            masked = np.unpackbits(packed, axis=1, bitorder="little")[:, at].view(bool)
        yield _score_block(q_ids[part], q_k[part], q_mat[part], x_ids, by_dim, squares, metric, masked, None if bar is None else bar[part])


def _score_block(q_ids, q_k, q_mat, x_ids, x_by_dim, x_sq, metric, masked=None, bar=None, keys=None):
    """The k best of a block per query; of those at or below its ``bar``, the cost of a k-th found before, if given.

    ``keys`` are those of the queries and of the items, by place: only pairs that agree at one of them count.
    """
    rough = q_mat @ x_by_dim
    q_sq = np.einsum("ij,ij->i", q_mat, q_mat)
    if metric == "dot":
        rough *= -1
        slack = np.sqrt(q_sq * x_sq.max())
    else:  # the query's own square shifts all its distances alike
        rough *= -2
        rough += x_sq
        slack = q_sq + x_sq.max()
    if masked is not None:
        rough[masked] = np.inf
    k = np.minimum(q_k, len(x_ids))
    if bar is not None and np.isfinite(bar).all():
        kth = bar if metric == "dot" else bar - q_sq
    elif k.min() == k.max():
        kth = np.partition(rough, k[0] - 1, axis=1)[:, k[0] - 1]
    else:
        kth = np.take_along_axis(np.sort(rough, axis=1), k[:, None] - 1, axis=1)[:, 0]
    # The matrix product rounds differently from block to block; keep whatever it cannot tell apart.
    near = rough <= (kth + 1e-10 * slack)[:, None]
    if masked is not None:
        near &= ~masked
    q_at, x_at = np.divmod(np.flatnonzero(near), len(x_ids))
    if keys is not None and masked is None:
        agree = (keys[0][q_at] == keys[1][x_at]).any(axis=1)
        q_at, x_at = q_at[agree], x_at[agree]
    cost = np.zeros(len(q_at))
    for q_dim, x_dim in zip(np.ascontiguousarray(q_mat.T), x_by_dim):
        a, b = q_dim[q_at], x_dim[x_at]
        cost += -(a * b) if metric == "dot" else (a - b) ** 2
    return _ranked(q_ids[q_at], q_k[q_at], x_ids[x_at], cost)


def _ranked(q, k, x, cost):
    order = np.lexsort((x, cost, q))
    q, k, x, cost = q[order], k[order], x[order], cost[order]
    rank = np.arange(1, len(q) + 1) - np.searchsorted(q, q)
    keep = rank <= k
    return q[keep], k[keep], x[keep], cost[keep], rank[keep].astype(np.int32)


def _best(found):
    """The k best per query over several results; a pair met in two cells counts once."""
    found = list(found)
    if not found:
        return None
    q, k, x, cost, _ = (np.concatenate(column) for column in zip(*found))
    if len(found) > 1:
        order = np.lexsort((x, q))
        same = (np.diff(q[order]) == 0) & (np.diff(x[order]) == 0)
        first = order[np.concatenate(([True], ~same))]
        q, k, x, cost = q[first], k[first], x[first], cost[first]
    return _ranked(q, k, x, cost)


def _table(found) -> pa.Table:
    schema = pa.schema(
        [("q", pa.int64()), ("k", pa.int32()), ("x", pa.int64()), ("cost", pa.float64()), ("rank", pa.int32())]
    )
    if found is None:
        return schema.empty_table()
    return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(found, schema)], schema=schema)


def _emit(found):
    for part in found:
        if part is not None:
            yield from _table(part).to_batches(max_chunksize=65_536)
