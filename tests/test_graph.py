"""The neighbour graph: bounded lists, recall at the registered parameters, whole answers."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from earshot.operators import ann, graph
from earshot.plans import queries


def frame(spark, matrix):
    return spark.createDataFrame([(i, [float(v) for v in row]) for i, row in enumerate(matrix)], "id long, features array<double>")


@pytest.fixture(scope="module")
def planted(spark):
    draw = np.random.default_rng(2)
    matrix = draw.normal(size=(600, 8))
    matrix[300:360] = matrix[3] + 0.01 * draw.normal(size=(60, 8))  # a hub and its near copies
    vectors = frame(spark, matrix)
    return vectors, graph.build_graph(vectors, degree=8)


def test_recall_at_the_registered_parameters(spark, data):
    row = queries.graph_recall(spark, data).first()
    assert row["recall"] >= 0.9 and 0 < row["scored_share"] <= 1


def test_lists_are_bounded_and_hold_true_neighbours(spark, planted):
    vectors, built = planted
    assert built.count() == 600
    assert built.where(F.size("neighbours") > 16).isEmpty() and built.where("neighbours is null").isEmpty()
    listed = built.select(F.col("id").alias("query_id"), F.explode("neighbours.id").alias("id"))
    assert listed.where("id = query_id").isEmpty()
    exact = ann.exact_neighbours(queries._asked(vectors), vectors, 9).where("id <> query_id")
    assert ann.recall_per_query(listed, exact).agg(F.avg("recall")).first()[0] > 0.9


def test_walks_end_with_k_vectors_and_true_distances(spark, planted):
    vectors, built = planted
    asked = queries._asked(vectors.where("id % 5 = 0"))
    found = graph.graph_search(asked, built, 10, pool=24).cache()
    assert found.groupBy("query_id").count().where("count <> 10").isEmpty()
    exact = ann.exact_neighbours(asked, vectors, 10)
    assert ann.recall_per_query(found, exact).agg(F.avg("recall")).first()[0] > 0.95
    assert found.join(exact.withColumnRenamed("score", "distance"), ["query_id", "id"]).where("abs(score - distance) > 1e-9").isEmpty()
    assert found.agg(F.max("scored")).first()[0] < 600


def test_few_equal_and_no_vectors(spark):
    same = frame(spark, np.ones((4, 3)))
    built = graph.build_graph(same, degree=2)
    assert graph.graph_search(queries._asked(same), built, 10).count() == 16
    one = frame(spark, np.ones((1, 3)))
    assert graph.graph_search(queries._asked(one), graph.build_graph(one), 3).count() == 1
    none = graph.build_graph(one.limit(0))
    assert none.count() == 0 and graph.graph_search(queries._asked(one), none, 3).count() == 0


def test_pairs_that_met_before_or_stand_above_the_bar_do_not_leave_a_task(spark):
    rows = [([1, 2, 3], [[0.0], [1.0], [3.0]], [True, False, False], [float("inf"), 0.5, float("inf")])]
    groups = spark.createDataFrame(rows, "ids array<long>, vectors array<array<float>>, fresh array<boolean>, bars array<double>")
    assert sorted(tuple(r) for r in graph._met(groups, 2).collect()) == [(1, 2, 1.0), (1, 3, 9.0), (3, 1, 9.0)]


def test_vectors_move_in_single_precision_only_where_it_holds_them(spark):
    exact, other = frame(spark, [[0.5, -2.0]]), frame(spark, [[0.1, -2.0]])
    kinds = [graph.build_graph(f).schema["features"].dataType.elementType.typeName() for f in (exact, other)]
    assert kinds == ["float", "double"]
