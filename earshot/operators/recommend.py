"""Top-k item lists per user: from latent factors, or simply the most popular items."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from earshot.operators.topk import top_k, top_k_unseen

LIST_LENGTH = 500


def recommend(
    user_factors: DataFrame,
    item_factors: DataFrame,
    users: DataFrame | None = None,
    k: int = LIST_LENGTH,
    seen: DataFrame | None = None,
) -> DataFrame:
    """(user_index, item_index, rating, position) by factor dot product.

    Factors are (id, features). ``users`` limits whom to serve; a user without factors gets no
    list. Items already in ``seen`` (user_index, item_index) are left out when it is given; they
    are masked where a block is scored, so a heavy user costs no more than any other.
    """
    asking = user_factors.withColumnRenamed("id", "user_index")
    if users is not None:
        asking = asking.join(users.select("user_index").distinct(), "user_index", "left_semi")
    if seen is None:
        return _lists(top_k(asking, item_factors, k, "dot", query_id="user_index"))
    return _lists(top_k_unseen(asking, item_factors, seen.withColumnRenamed("item_index", "id"), k, "dot", query_id="user_index"))


def _lists(found: DataFrame) -> DataFrame:
    return found.select(
        "user_index",
        F.col("id").cast("int").alias("item_index"),
        F.col("score").alias("rating"),
        F.col("rank").alias("position"),
    )


def popular_items(train: DataFrame, k: int = LIST_LENGTH, weight: str | None = None) -> DataFrame:
    """(item_index, score, position): most interacted items, or largest sum of ``weight``."""
    score = F.sum(weight) if weight else F.count(F.lit(1))
    best = train.groupBy("item_index").agg(score.alias("score")).orderBy(F.desc("score"), "item_index")
    by_score = Window.orderBy(F.desc("score"), "item_index")  # over the k rows of the limit
    return best.limit(k).withColumn("position", F.row_number().over(by_score))


def recommend_popular(popular: DataFrame, users: DataFrame) -> DataFrame:
    """Give every user the same list. The list is one array of k entries, read as a scalar."""
    entries = F.array_sort(F.collect_list(F.struct("position", "item_index", F.col("score").alias("rating"))))
    everyone = users.select("user_index").distinct()
    listed = everyone.withColumn("list", popular.agg(entries).scalar())
    return listed.select("user_index", F.inline("list")).select(
        "user_index", "item_index", "rating", "position"
    )


def nest(lists: DataFrame) -> DataFrame:
    """(user_index, recommendations array<struct<item_index, rating>>), best first; k per user."""
    entry = F.struct("position", "item_index", "rating")
    nested = lists.groupBy("user_index").agg(F.array_sort(F.collect_list(entry)).alias("entries"))
    kept = F.transform("entries", lambda e: F.struct(e["item_index"], e["rating"]))
    return nested.select("user_index", kept.alias("recommendations"))


def unnest(nested: DataFrame) -> DataFrame:
    """Back to one row per recommendation."""
    rows = nested.select("user_index", F.posexplode("recommendations").alias("at", "entry"))
    return rows.select("user_index", "entry.*", (F.col("at") + 1).alias("position"))
