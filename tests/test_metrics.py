import math

import pytest
from pyspark.ml.evaluation import RankingEvaluator
from pyspark.sql import functions as F

from earshot.operators import metrics

PRED = {1: [1, 2, 3, 4], 2: [5, 6], 3: [1, 2], 4: [1, 2, 3]}
LABEL = {1: [2, 4, 9], 2: [7], 3: [], 4: [1, 1, 2]}


def lists(spark, pred):
    rows = [(u, i, p) for u, items in pred.items() for p, i in enumerate(items, 1)]
    return spark.createDataFrame(rows, "user_index int, item_index int, position int")


def labels(spark, label):
    rows = [(u, i) for u, items in label.items() for i in (items or [None])]
    return spark.createDataFrame(rows, "user_index int, item_index int")


def test_hand_computed_values(spark):
    found = metrics.ranking_metrics(lists(spark, PRED), labels(spark, LABEL), (3,)).first()
    want = {"map": 1 / 3, "map_at_3": 0.291667, "precision_at_3": 0.25, "recall_at_3": 1 / 3, "ndcg_at_3": 0.324020}
    assert found.users == 4 and found.coverage == 1
    assert {k: found[k] for k in want} == pytest.approx(want, abs=1e-6)


def test_single_user(spark):
    found = metrics.per_user_metrics(lists(spark, {1: PRED[1]}), labels(spark, {1: LABEL[1]})).first()
    assert found.ap == pytest.approx(1 / 3) and found.n_labels == 3 and found.hits == 2


def test_agrees_with_ranking_evaluator(spark):
    label = {u: sorted(set(v)) for u, v in LABEL.items() if v}
    pred = {u: PRED[u] for u in label}
    rows = [([float(i) for i in pred[u]], [float(i) for i in label[u]]) for u in label]
    df = spark.createDataFrame(rows, "prediction array<double>, label array<double>")
    found = metrics.ranking_metrics(lists(spark, pred), labels(spark, label), (2, 3)).first()
    assert found["map"] == pytest.approx(RankingEvaluator(metricName="meanAveragePrecision").evaluate(df))
    for k in (2, 3):
        for ours, theirs in (("map", "meanAveragePrecisionAtK"), ("precision", "precisionAtK"), ("recall", "recallAtK"), ("ndcg", "ndcgAtK")):
            want = RankingEvaluator(metricName=theirs, k=k).evaluate(df)
            assert found[f"{ours}_at_{k}"] == pytest.approx(want), (ours, k)


def test_users_missing_on_either_side(spark):
    pred, label = {1: [1], 2: [2], 5: [1]}, {1: [1], 2: [3], 3: [1], 4: [2]}
    found = metrics.ranking_metrics(lists(spark, pred), labels(spark, label)).first()
    assert (found.users, found["map"], found.coverage, found.map_all_users) == (2, 0.5, 0.5, 0.25)


def test_several_models_side_by_side(spark):
    both = lists(spark, {1: [1, 2]}).withColumn("model", F.lit("a")).union(lists(spark, {1: [2, 1]}).withColumn("model", F.lit("b")))
    found = metrics.ranking_metrics(both, labels(spark, {1: [2]}), by=("model",)).collect()
    assert {r.model: r["map"] for r in found} == {"a": 0.5, "b": 1.0}


def test_ndcg_of_a_perfect_list_is_one(spark):
    found = metrics.ranking_metrics(lists(spark, {1: [1, 2, 3]}), labels(spark, {1: [3, 2, 1]}), (2, 3, 10)).first()
    assert [found[f"ndcg_at_{k}"] for k in (2, 3, 10)] == pytest.approx([1, 1, 1])
    assert found.precision_at_10 == pytest.approx(0.3) and math.isclose(found.recall_at_2, 2 / 3)


def test_error_rate_and_best_row(spark):
    df = spark.createDataFrame([(1, 1.0), (2, 3.0), (0, 0.0), (4, 0.0)], "label int, prediction double")
    assert tuple(metrics.error_rate(df).first()) == (2, 4, 0.5)
    board = spark.createDataFrame([(0, 0.1), (4, 0.5), (1, 0.5), (2, None)], "position int, score double")
    assert metrics.best_row(board, "score").first().position == 1


def test_a_common_list_scores_like_the_same_list_for_every_user(spark):
    labels = spark.createDataFrame([(1, 10), (1, 11), (2, 30), (2, 30), (3, None), (4, 12)], "user_index int, item_index int")
    common = spark.createDataFrame([("a", 10, 1), ("a", 12, 2), ("b", 11, 1)], "model string, item_index int, position int")
    users = labels.select("user_index").distinct()
    expanded = common.join(users, how="cross")
    for by in (("model",), ()):
        lists = [df if by else df.where("model = 'a'").drop("model") for df in (common, expanded)]
        got, want = (sorted(map(tuple, metrics.per_user_metrics(df, labels, (1, 2), by).collect())) for df in lists)
        assert got == want and len(got) == (8 if by else 4)
        plan = metrics.per_user_metrics(lists[0], labels, (1, 2), by)._jdf.queryExecution().toString()
        assert "CartesianProduct" not in plan
    assert metrics.per_user_metrics(common.limit(0), labels, by=("model",)).count() == 0


def test_one_pass_map_equals_the_metrics(spark):
    rows = [(u, (u * 5 + p * p) % 17, p) for u in range(9) for p in range(1, 8)]
    lists = spark.createDataFrame(rows, "user_index int, item_index int, position int")
    labels = spark.createDataFrame(
        [(u, (u + 3 * i) % 17) for u in range(4, 14) for i in range(5)] * 2 + [(8, None), (20, None)], "user_index int, item_index int"
    )
    want = metrics.ranking_metrics(lists, labels).first()
    got = metrics.mean_average_precision(lists, labels).first()
    assert got["users"] == want["users"] and got["coverage"] == want["coverage"]
    assert abs(got["map"] - want["map"]) < 1e-12 and want["map"] > 0
    nothing = metrics.mean_average_precision(lists.limit(0), labels).first()
    assert nothing["map"] is None and nothing["users"] == 0
