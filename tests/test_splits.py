import pytest
from pyspark.sql import functions as F

from earshot.functions.counts import VARIANTS, drop_low, log_compress, modify
from earshot.functions.hashing import HASH_RANGE, drawn, key_hash
from earshot.operators import splits
from earshot.operators.histories import user_histories
from earshot.sources import tables


def rows(df):
    return sorted(map(tuple, df.collect()))


@pytest.fixture(scope="module")
def inter(spark, data):
    return tables.interactions(spark, data).cache()


def test_hash_is_uniform_and_salted(spark):
    df = spark.range(20000).select(key_hash("id").alias("a"), key_hash("id", salt="x").alias("b"))
    low, high, half, differ = df.agg(
        F.min("a"), F.max("a"), F.avg((F.col("a") < HASH_RANGE // 2).cast("int")), F.avg((F.col("a") != F.col("b")).cast("int"))
    ).first()
    assert 0 <= low and high < HASH_RANGE and abs(half - 0.5) < 0.02 and differ > 0.99
    assert spark.range(20000).where(drawn(1.0, "id")).count() == 20000
    assert spark.range(20000).where(drawn(0.0, "id")).count() == 0


def test_samples_do_not_depend_on_the_layout(inter):
    first = rows(splits.hash_sample(inter, 0.1, "user_id", "track_id"))
    again = rows(splits.hash_sample(inter.repartition(7), 0.1, "user_id", "track_id"))
    assert first == again and 0.07 < len(first) / inter.count() < 0.13


def test_holdout_keeps_every_row_and_hides_only_held_out_users(inter):
    split = splits.holdout_histories(inter, valid=0.1, test=0.2).cache()
    assert split.count() == inter.count()
    users = {r.split: r.users for r in split.groupBy("split").agg(F.collect_set("user_id").alias("users")).collect()}
    assert not set(users["valid"]) & set(users["test"])
    held = set(users["valid"]) | set(users["test"])
    assert 0.2 < len(held) / inter.select("user_id").distinct().count() < 0.4
    assert held <= set(users["train"])  # partial histories stay visible
    assert rows(split) == rows(splits.holdout_histories(inter.repartition(5), valid=0.1, test=0.2))


def test_sample_with_users_keeps_whole_histories(spark, inter):
    keep = spark.createDataFrame([(1,), (2,), (2,), (10**9,)], "user_id bigint")
    found = splits.sample_with_users(inter, keep, 0.05)
    assert found.columns == inter.columns
    kept = inter.where("user_id in (1, 2)")
    assert rows(found.where("user_id in (1, 2)")) == rows(kept)
    others = splits.hash_sample(inter, 0.05, "user_id", "track_id").where("user_id not in (1, 2)")
    assert rows(found.where("user_id not in (1, 2)")) == rows(others)


def test_item_holdout_separates_items(inter):
    kept, cold = splits.hold_out_items(inter, 0.2)
    items = [{r.track_id for r in df.collect()} for df in (kept, cold)]
    assert not items[0] & items[1] and items[1]
    assert kept.count() + cold.count() == inter.count()


def test_query_sample_is_distinct_and_stable(spark):
    df = spark.range(1000)
    first = [r.id for r in splits.sample_queries(df, 50).collect()]
    assert len(set(first)) == 50
    assert first == [r.id for r in splits.sample_queries(df.repartition(9), 50).collect()]


def test_histories_hold_distinct_sorted_items(spark):
    df = spark.createDataFrame([(1, 5), (1, 3), (1, 5), (2, 7)], "user_index int, item_index int")
    assert rows(user_histories(df, parts=1)) == [(1, 0, [3, 5]), (2, 0, [7])]


def test_long_histories_come_in_parts_and_lose_nothing(spark):
    one = spark.range(5000).select(F.lit(1).alias("user_index"), F.col("id").cast("int").alias("item_index"))
    df = one.union(spark.createDataFrame([(2, 7)], "user_index int, item_index int"))
    found = user_histories(df, parts=10).collect()
    hot = [r for r in found if r.user_index == 1]
    assert [r.part for r in sorted(hot, key=lambda r: r.part)] == list(range(10)) and max(len(r.label) for r in hot) < 600
    assert sorted(i for r in hot for i in r.label) == list(range(5000))
    small = [(r.part, r.label) for r in found if r.user_index == 2]
    assert small == [(r.part, [7]) for r in hot if 7 in r.label]  # the part follows from the value alone


def test_count_variants(spark):
    df = spark.createDataFrame([(1, 1.0), (2, 9.0), (3, 99.0)], "id int, count double")
    assert [r["count"] for r in log_compress(df).orderBy("id").collect()][1:] == [1.0, 2.0]
    assert [r.id for r in drop_low(df).orderBy("id").collect()] == [2, 3]
    assert [r.id for r in drop_low(df, above=9).collect()] == [3]
    assert [r.id for r in modify(df, "SELECT id FROM __THIS__ WHERE count > 9").collect()] == [3]
    assert list(VARIANTS) == ["index", "log", "drop"]
