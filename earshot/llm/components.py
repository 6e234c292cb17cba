"""Connected components by alternating large-star and small-star rounds.

Each round replaces the edges of every node by edges to the smallest neighbour, first for larger
neighbours, then for smaller ones, until every node points at the smallest node of its component.
Neighbours are never gathered: a round is an aggregated minimum, combined before its shuffle, and a
lookup of these minima that leaves the edges where they are while the minima fit a broadcast by
counted size, and spreads the edges of hot nodes over many tasks beyond that. Rounds are cut by
stored tables, of which only the last two exist.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from earshot.operators.skew import lookup_join
from earshot.session import held, remove_path, scratch_path


@contextmanager
def _large_star(edges: DataFrame) -> Iterator[DataFrame]:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    with held(least, "least") as least:
        yield lookup_join(both.where("v > u"), least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


@contextmanager
def _small_star(edges: DataFrame) -> Iterator[DataFrame]:
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    with held(least, "least") as least:
        lower = lookup_join(edges, least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        yield lower.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for every node that is not the smallest of its component.

    ``component`` is the smallest node reachable. Self loops, repeated and null edges do not
    count; nodes without edges, and smallest nodes, are left out, so callers fall back on the
    node itself.
    """
    spark = edges.sparkSession

    def keep(df: DataFrame) -> tuple[DataFrame, str]:
        path = scratch_path(spark, "edges")
        df.write.parquet(path)
        return spark.read.schema("u long, v long").parquet(path), path

    oriented = edges.select(F.greatest(a, b).cast("long").alias("u"), F.least(a, b).cast("long").alias("v"))
    found, path = keep(oriented.where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col("u") > F.col("v"))).distinct())
    mark = lambda df: tuple(df.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first())
    before = mark(found)
    while before[0]:
        with _large_star(found) as large, held(large, "large") as large, _small_star(large) as small:
            new, new_path = keep(small)
        remove_path(spark, path)
        found, path, after = new, new_path, mark(new)
        if after == before:
            break
        before = after
    return found.select(F.col("u").alias("node"), F.col("v").alias("component"))
