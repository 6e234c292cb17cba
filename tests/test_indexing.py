import pytest
from pyspark.ml.feature import StringIndexer
from pyspark.sql import functions as F

from earshot.operators.indexing import apply_index, fit_index, index_pairs
from earshot.operators.skew import lookup_join
from earshot.sources import tables


def keys(spark, values):
    return spark.createDataFrame([(v,) for v in values], "k string")


def test_order_is_frequency_then_text(spark):
    index = fit_index(keys(spark, ["b", "a", "c", "c", "10", "9", None]), "k", "i")
    assert [r.k for r in index.orderBy("i").collect()] == ["c", "10", "9", "a", "b"]
    assert [r.i for r in index.orderBy("i").collect()] == [0, 1, 2, 3, 4]
    assert index.schema["i"].dataType.simpleString() == "int"


def test_unseen_and_null_keys_are_dropped(spark):
    index = fit_index(keys(spark, ["b", "a", "c", "c", "10", "9"]), "k", "i")
    found = apply_index(keys(spark, ["zz", "a", None]), index, "k").collect()
    assert [(r.k, r.i) for r in found] == [("a", 3)]


def test_unseen_keys_raise_on_request(spark):
    index = fit_index(keys(spark, ["a"]), "k", "i")
    assert apply_index(keys(spark, ["a"]), index, "k", unseen="error").count() == 1
    for bad in ("zz", None):
        with pytest.raises(Exception, match="unseen k"):
            apply_index(keys(spark, ["a", bad]), index, "k", unseen="error").collect()


def test_numeric_keys_tie_as_text(spark):
    df = spark.createDataFrame([(9,), (10,), (2,)], "k bigint")
    assert [r.k for r in fit_index(df, "k", "i").orderBy("i").collect()] == [10, 2, 9]


def test_agrees_with_string_indexer_over_many_partitions(spark, data):
    rows = tables.interactions(spark, data).select(F.col("track_id").cast("string")).repartition(13)
    ours = {r.track_id: r.i for r in fit_index(rows, "track_id", "i").collect()}
    labels = StringIndexer(inputCol="track_id", outputCol="x").fit(rows).labels
    assert ours == {label: i for i, label in enumerate(labels)}


def test_both_indexes_drop_rows_unseen_in_either(spark):
    train = spark.createDataFrame([("u", "t", 1.0), ("v", "t", 2.0)], "user_id string, track_id string, count double")
    users, items = fit_index(train, "user_id", "user_index"), fit_index(train, "track_id", "item_index")
    new = spark.createDataFrame([("u", "t", 1.0), ("x", "t", 1.0), ("u", "s", 1.0)], train.schema)
    assert [(r.user_index, r.item_index) for r in index_pairs(new, users, items).collect()] == [(0, 0)]


@pytest.mark.parametrize("how", ["inner", "left"])
def test_lookup_join_gives_the_same_rows_beyond_the_broadcast_bound(spark, how):
    """One key owns a third of the rows and is spread over several parts."""
    facts = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), "id")
    lookup = spark.range(0, 3000, 2).select(F.col("id").alias("k"), (F.col("id") * 10).alias("v"))
    plain = sorted(map(tuple, facts.join(lookup, "k", how).select("k", "id", "v").collect()), key=repr)
    salted = lookup_join(facts, lookup, "k", how, max_broadcast=10, hot_rows=100)
    assert sorted(map(tuple, salted.select("k", "id", "v").collect()), key=repr) == plain
    unskewed = lookup_join(facts, lookup, "k", how, max_broadcast=10)
    assert sorted(map(tuple, unskewed.select("k", "id", "v").collect()), key=repr) == plain
