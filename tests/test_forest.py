"""The random-projection forest: whole index, bounded cost, recall at the registered parameters."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from earshot.operators import ann, forest
from earshot.plans import queries
from earshot.session import stored


def frame(spark, matrix):
    return spark.createDataFrame([(i, [float(v) for v in row]) for i, row in enumerate(matrix)], "id long, features array<double>")


@pytest.mark.parametrize("root", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_recall_and_cost_at_the_registered_parameters(spark, root):
    row = queries.forest_recall(spark, root).first()
    assert row["recall"] >= 0.9 and row["scored_share"] <= 0.1


def test_results_do_not_depend_on_blocks_or_layout_beyond_the_quota(spark):
    draw = np.random.default_rng(3)
    vectors = frame(spark, draw.normal(size=(400, 12)))
    trees = forest.fit_forest(vectors, trees=20)
    asked = vectors.where("id % 9 = 0").withColumnRenamed("id", "query_id")
    indexed = stored(forest.index_forest(trees, vectors), "forest")
    find = lambda **o: sorted(map(tuple, forest.forest_search(trees, asked, indexed, 5, **o).drop("touched").collect()))
    assert find() == find(query_block=7)
    assert [r[:4] for r in find(share=1.0, item_block=50)] == [r[:4] for r in find(share=1.0)]
    exact = ann.exact_neighbours(asked, vectors, 5).select("query_id", "id", "score", "rank")
    assert [r[:4] for r in find(share=1.0)] == sorted(map(tuple, exact.collect()))


def test_scored_vectors_stay_within_the_share(spark):
    draw = np.random.default_rng(5)
    vectors = frame(spark, np.concatenate([draw.normal(size=(300, 8)), np.ones((300, 8))]))  # a third and more are copies
    trees = forest.fit_forest(vectors, trees=16)
    indexed = stored(forest.index_forest(trees, vectors), "forest")
    found = forest.forest_search(trees, queries._asked(vectors), indexed, 5, share=0.2)
    assert found.groupBy("query_id").count().where("count <> 5").isEmpty()
    assert found.agg(F.max("scored")).first()[0] <= 0.2 * 600


def test_leaves_are_balanced_and_every_vector_has_one(spark):
    draw = np.random.default_rng(7)
    matrix = draw.normal(size=(1000, 10))
    trees = forest.fit_forest(frame(spark, matrix), trees=8, leaf=50)
    leaves = trees.leaves(matrix)
    assert leaves.shape == (1000, 8) and leaves.min() >= 0 and leaves.max() < 1 << trees.depth
    for t in range(8):
        assert np.bincount(leaves[:, t]).max() <= 80
    node, chance = trees.probes(matrix[:50], 1 << trees.depth)
    assert np.allclose(chance.sum(2), 1, atol=1e-3)
    assert (node[np.arange(50)[:, None], np.arange(8), chance.argmax(2)] == leaves[:50]).mean() > 0.7


def test_few_and_equal_vectors(spark):
    same = frame(spark, np.ones((3, 4)))
    trees = forest.fit_forest(same, trees=4)
    found = forest.forest_search(trees, queries._asked(same), forest.index_forest(trees, same), 5)
    assert found.count() == 9 and found.where("score <> 0").isEmpty()
    none = forest.forest_search(trees, queries._asked(same), forest.index_forest(trees, same.limit(0)), 5)
    assert none.count() == 0
