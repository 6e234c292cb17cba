import numpy as np
import pytest
from pyspark.ml.recommendation import ALSModel
from pyspark.sql import functions as F

from earshot.functions.hashing import key_hash
from earshot.operators import metrics, models, recommend, splits
from earshot.operators.coldstart import patch_factors, save_patched_model

# Planted structure: users of four blocks prefer the items of their own block.
BLOCKS, USERS, ITEMS = 4, 50, 40


@pytest.fixture(scope="module")
def planted(spark):
    users = spark.range(BLOCKS * USERS).select(F.col("id").cast("int").alias("user_index"))
    items = F.explode(F.sequence(F.lit(0), F.lit(BLOCKS * ITEMS - 1))).alias("item_index")
    own = F.expr(f"user_index div {USERS} = item_index div {ITEMS}")
    percent = lambda salt: key_hash("user_index", "item_index", salt=salt) % 100
    rows = (
        users.select("user_index", items)
        .where(percent("a") < F.when(own, 60).otherwise(2))
        .withColumn("count", (1 + percent("c") % 5).cast("double"))
        .cache()
    )
    train, held = splits.split_rows(rows, 0.2, "user_index", "item_index", salt="s")
    return train.cache(), held.cache()


@pytest.fixture(scope="module")
def model(planted):
    return models.fit_als(planted[0], models.Params(5, 0.1, 1.0), blocks=2)


def score(lists, labels):
    return metrics.ranking_metrics(lists, labels).first()["map"]


def test_als_finds_planted_taste_better_than_popularity(planted, model):
    train, held = planted
    popular = recommend.recommend_popular(recommend.popular_items(train), held)
    als = recommend.recommend(model.userFactors, model.itemFactors, held)
    assert score(als, held) > 1.5 * score(popular, held)
    unseen = recommend.recommend(model.userFactors, model.itemFactors, held, seen=train)
    assert score(unseen, held) > 1.5 * score(als, held)


def test_list_invariants(planted, model):
    lists = recommend.recommend(model.userFactors, model.itemFactors, planted[1], k=20).collect()
    by_user = {}
    for r in sorted(lists, key=lambda r: r.position):
        by_user.setdefault(r.user_index, []).append(r)
    assert set(by_user) == {r.user_index for r in planted[1].collect()}
    for rows in by_user.values():
        assert [r.position for r in rows] == list(range(1, 21))
        assert len({r.item_index for r in rows}) == 20
        assert all(a.rating >= b.rating for a, b in zip(rows, rows[1:]))


def test_agrees_with_the_model_itself(planted, model):
    """The model scores in single precision, so neighbours closer than that may swap."""
    users = planted[1].select("user_index").distinct()
    theirs = {r.user_index: r.recommendations for r in model.recommendForUserSubset(users, 10).collect()}
    nested = recommend.nest(recommend.recommend(model.userFactors, model.itemFactors, users, k=10))
    ours = {r.user_index: r.recommendations for r in nested.collect()}
    assert set(ours) == set(theirs)
    for user, found in ours.items():
        assert [e.rating for e in found] == pytest.approx([e.rating for e in theirs[user]], abs=1e-5)


def test_seen_items_are_left_out_and_lists_stay_full(planted, model):
    train, held = planted
    lists = recommend.recommend(model.userFactors, model.itemFactors, held, k=30, seen=train)
    assert lists.join(train, ["user_index", "item_index"]).count() == 0
    sizes = lists.groupBy("user_index").agg(F.count("*").alias("n"), F.max("position").alias("last")).collect()
    assert {(r.n, r.last) for r in sizes} == {(30, 30)}


def test_users_without_factors_get_nothing(spark, planted, model):
    users = spark.createDataFrame([(0,), (0,), (10**6,)], "user_index int")
    lists = recommend.recommend(model.userFactors, model.itemFactors, users, k=3)
    assert [r.user_index for r in lists.collect()] == [0, 0, 0]


def test_popularity_ties_and_weights(spark):
    rows = spark.createDataFrame([(1, 5, 1.0), (2, 5, 1.0), (1, 3, 9.0), (1, 2, 1.0)], "user_index int, item_index int, count double")
    assert [r.item_index for r in recommend.popular_items(rows, 2).orderBy("position").collect()] == [5, 2]
    assert [r.item_index for r in recommend.popular_items(rows, 2, "count").orderBy("position").collect()] == [3, 5]
    lists = recommend.recommend_popular(recommend.popular_items(rows, 2), rows).collect()
    assert sorted((r.user_index, r.position, r.item_index) for r in lists) == [(1, 1, 5), (1, 2, 2), (2, 1, 5), (2, 2, 2)]


def test_nesting_round_trip(planted, model):
    lists = recommend.recommend(model.userFactors, model.itemFactors, planted[1], k=5)
    back = recommend.unnest(recommend.nest(lists)).select(*lists.columns)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, lists.collect()))


def test_saved_model_and_leaderboard(spark, planted, tmp_path):
    train, held = planted
    points = models.grid(ranks=(2, 5), regs=(0.1,), alphas=(1.0,))
    models.train_grid(train, points, str(tmp_path), share=0.02, blocks=2)
    assert models.model_path("m", points[1], 0.02) == "m/model_reg_0.1_rank5_a_1.0_0.02"
    board = models.evaluate_grid(held, points, str(tmp_path), share=0.02, k=50).collect()
    direct = models.grid_search(train, held, points, k=50, blocks=2).collect()
    assert [(r.position, r.rank) for r in board] == [(0, 2), (1, 5)]
    assert [r["map"] for r in board] == pytest.approx([r["map"] for r in direct])
    assert all(0 < r["map"] < 1 and r.coverage == 1 and r.fit_seconds > 0 for r in board)
    path = models.model_path(str(tmp_path), points[0], 0.02)
    loaded = models.load_factors(spark, path, "item")
    assert {len(r.features) for r in loaded.collect()} == {2}
    assert loaded.count() == models.load_als(path).itemFactors.count()
    models.train_grid(train, points[:1], str(tmp_path), share=0.02, blocks=2)  # overwrites


def test_full_grid_has_one_definition():
    points = models.grid()
    assert len(points) == 6 * 3 * 3 and points[0] == models.Params(5, 0.01, 0.1)
    assert [p.rank for p in points] == sorted(p.rank for p in points)


def test_patched_model_directory_still_recommends(spark, planted, model, tmp_path):
    path = str(tmp_path / "model")
    models.save_model(model, path)
    factors = models.load_factors(spark, path, "item")
    mean = np.mean([r.features for r in factors.collect()], axis=0).tolist()
    cold = spark.createDataFrame([(3, mean), (7, mean)], "item_index bigint, features array<double>")
    patched = patch_factors(factors, cold)
    assert patched.count() == factors.count()
    target = str(tmp_path / "patched")
    save_patched_model(path, patched, target)
    loaded = ALSModel.load(target)
    users = planted[1].select("user_index").distinct()
    assert loaded.recommendForUserSubset(users, 5).count() == users.count()
    by_id = {r.id: r.features for r in loaded.itemFactors.where("id in (3, 7)").collect()}
    assert by_id[3] == by_id[7] == pytest.approx(mean)
    with pytest.raises(ValueError):
        save_patched_model(path, patched, path)
