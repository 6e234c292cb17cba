"""The recommender's input tables, read from the commerce and text tables at hand.

A customer is a listener, a part is a track, the quantity bought is the play count. Track
metadata and tags come from ``part``, audio features and latent factors from ``embeddings``,
lyrics from ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TIMBRE = [f"timbre_{i:02d}" for i in range(12)]
AUDIO = [*TIMBRE, "loudness_mean", "loudness_std"]


def table(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{root}/{name}.parquet")


def interactions(spark: SparkSession, root: str) -> DataFrame:
    """(user_id, track_id, count): one row per pair, so later joins on the pair cannot skew."""
    orders = table(spark, root, "orders").select("o_orderkey", F.col("o_custkey").alias("user_id"))
    lines = table(spark, root, "lineitem").select(
        F.col("l_orderkey").alias("o_orderkey"), F.col("l_partkey").alias("track_id"), "l_quantity"
    )
    return (
        lines.join(orders, "o_orderkey")
        .groupBy("user_id", "track_id")
        .agg(F.sum("l_quantity").alias("count"))
    )


def tags(spark: SparkSession, root: str) -> DataFrame:
    """(track_id, tag): the words of the part name and its type."""
    part = table(spark, root, "part")
    words = F.concat(F.split("p_name", " "), F.array("p_type"))
    return part.select(F.col("p_partkey").alias("track_id"), F.explode(words).alias("tag"))


def metadata(spark: SparkSession, root: str) -> DataFrame:
    """(track_id, artist_id, year, ...); size 13 stands for an unknown year."""
    key = F.col("p_partkey")
    return table(spark, root, "part").select(
        key.alias("track_id"),
        F.col("p_brand").alias("artist_id"),
        F.nullif(F.col("p_size"), F.lit(13)).cast("double").alias("year"),
        F.col("p_retailprice").alias("duration"),
        ((key % 89) / 88.0).alias("artist_hotttnesss"),
        ((key % 101) / 100.0).alias("artist_familiarity"),
    )


def audio_features(spark: SparkSession, root: str) -> DataFrame:
    """(track_id, timbre_00..timbre_11, loudness_mean, loudness_std)."""
    values = [F.col("embedding")[i].cast("double").alias(c) for i, c in enumerate(AUDIO)]
    return table(spark, root, "embeddings").select(F.col("vec_id").alias("track_id"), *values)


def lyrics(spark: SparkSession, root: str) -> DataFrame:
    """(track_id, text)."""
    return table(spark, root, "documents").select(F.col("doc_id").alias("track_id"), "text")


def factors(spark: SparkSession, root: str) -> DataFrame:
    """(id, features, label): fixed latent vectors, for results SQL can check."""
    return table(spark, root, "embeddings").select(
        F.col("vec_id").alias("id"), F.col("embedding").cast("array<double>").alias("features"), "label"
    )
