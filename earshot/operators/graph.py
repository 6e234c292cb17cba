"""Neighbour graph: approximate neighbours by walking from vector to closer vector.

The graph is grown by neighbour descent: every vector starts with neighbours from a few small random
blocks, then rounds of bounded self-joins let the neighbours of a vector meet each other, and each
keeps its ``degree`` nearest. Walks also need ways back, so a finished vector lists up to ``degree``
vectors that point at it as well: no list is longer than twice the degree, hubs included.

A search keeps a pool of the nearest vectors met per query and opens several of them per round: one
join with the graph brings their neighbours, which are scored in the tasks. It ends when no query
has an unopened vector in its pool. A query scores only what it meets, and that count is reported.

Everything per vector or query is bounded by the degree and the pool; rounds are cut by stored
tables, of which only the last stays.
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from earshot.functions.hashing import key_hash
from earshot.operators.skew import broadcast_if_small
from earshot.session import remove_path, scratch_path, stored

cloudpickle.register_pickle_by_value(sys.modules[__name__])

DEGREE = 16
START_BLOCK = 64  # vectors of a random block that neighbours are first looked for in
STARTS = 4  # different random blocks of every vector, which is what connects the blocks
ROUNDS = 10  # of descent, at most
SETTLED = 0.002  # share of changed neighbours below which the graph is finished
POOL = 24
OPENED = 6  # vectors of the pool that a round opens
ENTRIES = 16  # vectors that every walk starts from
STEPS = 50  # rounds of a search, at most

PAIRS = "id long, other long, cost double"


def _write(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def _met(groups: DataFrame, keep: int) -> DataFrame:
    """Pairs of the vectors met in each row of (ids, vectors, fresh, bars): for each, the ``keep`` nearest others.

    Two vectors that are both not ``fresh`` have met before; a pair above the ``bar`` of a vector cannot enter its list.
    """

    def pair(batches):
        for batch in batches:
            out = []
            offsets = batch.column(0).offsets.to_numpy()
            all_ids, fresh, bars = (batch.column(c).values.to_numpy(zero_copy_only=False) for c in (0, 2, 3))
            lists = batch.column(1).values
            ends = lists.offsets.to_numpy()
            flat = lists.values.to_numpy(zero_copy_only=False)
            for a, b in zip(offsets[:-1], offsets[1:]):
                if b - a < 2:
                    continue
                ids = all_ids[a:b]
                x = flat[ends[a] : ends[b]].reshape(b - a, -1).astype(np.float64, copy=False)
                squares = (x * x).sum(1)
                cost = np.maximum(squares[:, None] + squares - 2 * x @ x.T, 0)
                cost[ids[:, None] == ids] = np.inf
                k = min(keep, len(ids) - 1)
                near = np.argpartition(cost, k - 1, axis=1)[:, :k]
                row = np.repeat(np.arange(len(ids)), k)
                near = near.ravel()
                found = cost[row, near]
                fits = np.isfinite(found) & (fresh[a:b][row] | fresh[a:b][near])
                fits &= found <= bars[a:b][row] + 1e-10 * (squares[row] + squares[near])  # a product rounds by its block
                out.append((ids[row[fits]], ids[near[fits]], found[fits]))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out)], ["id", "other", "cost"])

    return groups.select("ids", "vectors", "fresh", "bars").mapInArrow(pair, PAIRS)


def _nearest(pairs: DataFrame, degree: int) -> DataFrame:
    """The ``degree`` nearest others of every vector, each pair once; one shuffle, by the vector."""
    once = pairs.repartition("id").groupBy("id", "other").agg(F.min("cost").alias("cost"))
    order = Window.partitionBy("id").orderBy("cost", "other")
    return once.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= degree).drop("rank")


def _gather(members: DataFrame, vectors: DataFrame, by: list[str]) -> DataFrame:
    """(ids, vectors, fresh, bars) of the members of every group; ``vectors`` carry their ``bar``."""
    entry = F.collect_list(F.struct("id", "features", "fresh", "bar"))
    rows = members.join(vectors, "id").groupBy(*by).agg(entry.alias("m"))
    return rows.select(*[F.col(f"m.{c}").alias(n) for c, n in (("id", "ids"), ("features", "vectors"), ("fresh", "fresh"), ("bar", "bars"))])


def _narrow(vectors: DataFrame) -> DataFrame:
    """The same vectors in single precision where that holds every component, which halves what moves."""
    wide = F.exists("features", lambda v: ~v.eqNullSafe(v.cast("float").cast("double")))
    return vectors if vectors.where(wide).limit(1).count() else vectors.withColumn("features", F.col("features").cast("array<float>"))


def build_graph(vectors: DataFrame, degree: int = DEGREE, rounds: int = ROUNDS, block: int = START_BLOCK) -> DataFrame:
    """(id, features, neighbours array<struct<id, features>>) of (id, features); a stored table."""
    vectors = vectors.select(F.col("id").cast("long").alias("id"), F.col("features").cast("array<double>").alias("features"))
    vectors = stored(_narrow(vectors), "vectors")
    n = vectors.count()
    blocks = -(-n // block) or 1
    deals = F.array(*[F.struct(F.lit(s).alias("s"), F.pmod(key_hash("id", salt=f"block{s}"), F.lit(blocks)).alias("b")) for s in range(STARTS)])
    dealt = vectors.select("id", F.explode(deals).alias("d")).select("id", "d.*", F.lit(True).alias("fresh"))
    unbarred = vectors.withColumn("bar", F.lit(float("inf")))
    edges, path = _write(_nearest(_met(_gather(dealt, unbarred, ["s", "b"]), degree), degree), "edges")
    before = before_path = None
    for _ in range(rounds):
        # A vector's neighbours and some that point at it meet; hashed order picks which of a hub's.
        back = Window.partitionBy("other").orderBy(key_hash("id", "other", salt="back"), "id")
        backward = edges.withColumn("r", F.row_number().over(back)).where(F.col("r") <= degree)
        members = (
            edges.select("id", F.col("other").alias("m"))
            .union(backward.select(F.col("other").alias("id"), F.col("id").alias("m")))
            .union(vectors.select("id", F.col("id").alias("m")))
            .select(F.col("id").alias("at"), F.col("m").alias("id"))
            .repartition("at")
            .distinct()
        )
        # Members of a group in the round before have met there; a group without fresh ones is settled.
        old = F.lit(None).cast("boolean") if before is None else F.col("old")
        if before is not None:
            members = members.join(before.withColumn("old", F.lit(True)), ["at", "id"], "left")
        members = members.select("at", "id", old.isNull().alias("fresh"))
        members, members_path = _write(members.withColumn("open", F.max("fresh").over(Window.partitionBy("at"))), "members")
        bars = edges.groupBy("id").agg(F.when(F.count(F.lit(1)) >= degree, F.max("cost")).alias("bar"))
        barred = vectors.join(bars, "id", "left").withColumn("bar", F.coalesce("bar", F.lit(float("inf"))))
        found = _met(_gather(members.where("open").select("at", "id", "fresh"), barred, ["at"]), degree)
        new, new_path = _write(_nearest(edges.union(found), degree), "edges")
        if before is not None:
            remove_path(vectors.sparkSession, before_path)
        before, before_path = members.select("at", "id"), members_path
        changed = new.join(edges.select("id", "other"), ["id", "other"], "left_anti").count()
        remove_path(vectors.sparkSession, path)
        edges, path = new, new_path
        if changed <= SETTLED * degree * n:
            break
    if before is not None:
        remove_path(vectors.sparkSession, before_path)
    closest = Window.partitionBy("other").orderBy("cost", "id")
    backward = edges.withColumn("r", F.row_number().over(closest)).where(F.col("r") <= degree)
    ways = edges.select("id", "other").union(backward.select(F.col("other").alias("id"), F.col("id").alias("other"))).distinct()
    ends = ways.join(vectors.select(F.col("id").alias("other"), F.col("features").alias("v")), "other")
    lists = ends.groupBy("id").agg(F.array_sort(F.collect_list(F.struct(F.col("other").alias("id"), F.col("v").alias("features")))).alias("neighbours"))
    graph = stored(vectors.join(lists, "id", "left"), "graph")
    remove_path(vectors.sparkSession, path)
    return graph


def _scored(rows: DataFrame) -> DataFrame:
    """(query_id, met array<struct<cost, id>>) of (query_id, features, neighbours)."""

    def score(batches):
        for batch in batches:
            queries = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            neighbours = batch.column(2)
            sizes = neighbours.value_lengths().to_numpy()
            found = neighbours.flatten()
            ids, lists = found.flatten()
            x = lists.flatten().to_numpy(zero_copy_only=False).reshape(len(ids), queries.shape[1])  # in the graph's precision
            row = np.repeat(np.arange(batch.num_rows), sizes)
            cost = np.zeros(len(ids))
            for d in range(queries.shape[1]):  # term by term: the same score in every batch
                cost += (x[:, d] - queries[row, d]) ** 2
            entries = pa.StructArray.from_arrays([pa.array(cost), ids], ["cost", "id"])
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(sizes))), pa.int32()), entries)
            yield pa.RecordBatch.from_arrays([batch.column(0), lists], ["query_id", "met"])

    return rows.select("query_id", "features", "neighbours").mapInArrow(score, "query_id long, met array<struct<cost:double,id:long>>")


def graph_search(
    queries: DataFrame, graph: DataFrame, k: int, pool: int = POOL, opened: int = OPENED, entries: int = ENTRIES, steps: int = STEPS
) -> DataFrame:
    """(query_id, id, score, rank, scored): the ``k`` nearest vectors met, and how many were met."""
    spark, pool = queries.sparkSession, max(pool, k)
    asked = queries.select(F.col("query_id").cast("long").alias("query_id"), F.col("features").cast("array<double>").alias("features"))
    first = graph.orderBy(key_hash("id", salt="entry"), "id").limit(entries).select(F.struct("id", "features").alias("e"))
    first = first.agg(F.array_sort(F.collect_list("e")).alias("neighbours"))  # ``entries`` vectors
    start = _scored(asked.crossJoin(F.broadcast(first)).where(F.size("neighbours") > 0))
    # pool: the nearest vectors met, best first; shut: those of them opened already; seen: all met.
    state = asked.join(start, "query_id").select(
        "query_id", "features", F.slice(F.array_sort("met"), 1, pool).alias("pool"), F.expr("cast(array() as array<bigint>)").alias("shut"), F.col("met.id").alias("seen")
    )
    state, path = _write(state, "walk")
    for _ in range(steps):
        fresh = F.filter(F.col("pool.id"), lambda i: ~F.array_contains("shut", i))
        asking = state.withColumn("open", F.slice(fresh, 1, opened)).where(F.size("open") > 0)
        if asking.isEmpty():
            break
        opened_ids = broadcast_if_small(asking.select(F.explode("open").alias("id")).distinct())
        near = graph.select("id", "neighbours").join(opened_ids, "id", "left_semi")  # only what is opened moves
        ways = asking.select("query_id", "features", F.explode("open").alias("id")).join(near, "id")
        met = _scored(ways.where(F.col("neighbours").isNotNull()))
        met = met.groupBy("query_id").agg(F.array_distinct(F.flatten(F.collect_list("met"))).alias("met"))
        joined = state.withColumn("open", F.slice(fresh, 1, opened)).join(met, "query_id", "left")
        new = F.filter(F.coalesce("met", F.array().cast("array<struct<cost:double,id:bigint>>")), lambda m: ~F.array_contains("seen", m["id"]))
        state, new_path = _write(
            joined.withColumn("new", new).select(
                "query_id",
                "features",
                F.slice(F.array_sort(F.concat("pool", "new")), 1, pool).alias("pool"),
                F.concat("shut", "open").alias("shut"),
                F.concat("seen", F.col("new.id")).alias("seen"),
            ),
            "walk",
        )
        remove_path(spark, path)
        path = new_path
    found = state.select("query_id", F.size("seen").cast("long").alias("scored"), F.posexplode(F.slice("pool", 1, k)).alias("at", "e"))
    return found.select("query_id", F.col("e.id").alias("id"), F.col("e.cost").alias("score"), (F.col("at") + 1).alias("rank"), "scored")
