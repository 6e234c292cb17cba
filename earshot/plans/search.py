"""Comparison of neighbour search methods: recall against the exact answer, and queries per second."""

from __future__ import annotations

from pyspark.sql import DataFrame

from earshot.operators.ann import (
    assign_cells,
    bucket_search,
    cell_search,
    exact_neighbours,
    fit_buckets,
    fit_cells,
    hash_buckets,
    overfetch_recall,
    timed,
)
from earshot.operators.bootstrap import mean_interval
from earshot.operators.splits import sample_queries
from earshot.session import stored

# Neighbours per query, number of queries, and fetch multipliers of the study.
TOP_K = 100
QUERIES = 50
MULTIPLIERS = (1, 5)

COMPARISON = "method string, multiplier int, queries bigint, recall double, recall_low double, recall_high double, queries_per_second double"


def compare_methods(
    vectors: DataFrame,
    queries: int = QUERIES,
    k: int = TOP_K,
    multipliers: tuple[int, ...] = MULTIPLIERS,
    cells: int = 50,
    nprobe: int = 8,
    bucket_length: float = 0.5,
    tables: int = 8,
) -> DataFrame:
    """(method, multiplier, queries, recall, recall_low, recall_high, queries_per_second), one row per method and multiplier.

    The interval of the recall is that of resampled queries, which are a sample themselves.
    Here the exact side also grows to k*m, and fetching m times as much visits m times as many
    cells. Index construction is not part of the search time, and every row is timed on its own.
    """
    vectors = vectors.select("id", "features")
    asked = stored(sample_queries(vectors, queries).withColumnRenamed("id", "query_id"), "queries")
    centres = fit_cells(vectors, cells)
    in_cells = stored(assign_cells(vectors, centres), "cells")
    lsh = fit_buckets(vectors, bucket_length, tables)
    in_buckets = stored(hash_buckets(lsh, vectors), "buckets")
    methods = {
        "exact": lambda m: exact_neighbours(asked, vectors, k * m),
        "cells": lambda m: cell_search(asked, in_cells, centres, k * m, nprobe * m),
        "buckets": lambda m: bucket_search(lsh, asked, in_buckets, k * m),
    }
    rows = []
    for m in multipliers:
        truth = None
        for name, search in methods.items():
            found, seconds = timed(name, lambda: search(m))
            truth = found if truth is None else truth
            per_query = overfetch_recall(found, truth, k, [m], exact_k="k*m")
            recall = mean_interval(per_query, "recall", "query_id").first()
            rows.append((name, m, recall["n"], recall["mean"], recall["low"], recall["high"], recall["n"] / seconds))
    return vectors.sparkSession.createDataFrame(rows, COMPARISON)
