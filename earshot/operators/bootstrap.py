"""Sampling with replacement by hashed Poisson weights, and intervals of means from it.

A row of a resample occurs a Poisson(1) number of times, read off the hash of the draw and the
row's keys. So the resamples do not depend on partitioning or retries, nothing is collected, and
every draw is one partial aggregate a task.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from earshot.functions.hashing import HASH_RANGE, key_hash

DRAWS = 100
LEVEL = 0.95


def poisson_thresholds() -> list[int]:
    """Hash values from which a row occurs at least once, twice, ... in a resample."""
    found, below, n = [], 0.0, 0
    while True:
        below += math.exp(-1) / math.factorial(n)
        if round(below * HASH_RANGE) >= HASH_RANGE:
            return found
        found.append(round(below * HASH_RANGE))
        n += 1


def poisson_weight(*keys: Column | str, salt: str = "bootstrap") -> Column:
    """How often the row of ``keys`` occurs in a resample."""
    hashed = key_hash(*keys, salt=salt)
    return F.aggregate(
        F.lit(poisson_thresholds()).cast("array<bigint>"),
        F.lit(0).cast("bigint"),
        lambda n, least: n + (hashed >= least).cast("bigint"),
    )


def resampled(df: DataFrame, *keys: str, draws: int = DRAWS, salt: str = "bootstrap") -> DataFrame:
    """``df`` once per draw that holds the row, with ``draw`` from 0 and ``weight`` >= 1.

    ``keys`` tell the rows apart; rows that agree in them are drawn together.
    """
    every = df.withColumn("draw", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(draws - 1).cast("bigint"))))
    return every.withColumn("weight", poisson_weight("draw", *keys, salt=salt)).where("weight > 0")


def mean_interval(
    df: DataFrame, value: str, *keys: str, by: tuple[str, ...] = (), draws: int = DRAWS, level: float = LEVEL
) -> DataFrame:
    """(by..., n, mean, low, high): the mean of ``value`` and the bounds of ``level`` of its resampled means.

    Null values take no part. A group without values has no row; draws that hold none of its rows
    are left out.
    """
    keys = tuple(dict.fromkeys((*by, *keys)))
    rows = df.where(F.col(value).isNotNull()).select(*keys, F.col(value).cast("double").alias("_value"))
    # Draw -1 is the table itself, so one pass gives the mean and its resamples.
    every = rows.withColumn("draw", F.explode(F.sequence(F.lit(-1).cast("bigint"), F.lit(draws - 1).cast("bigint"))))
    own = F.col("draw") < 0
    weight = F.when(own, F.lit(1)).otherwise(poisson_weight("draw", *keys))
    weighted = F.sum(F.col("_value") * F.col("_weight")) / F.sum("_weight")
    means = (
        every.withColumn("_weight", weight)
        .where("_weight > 0")
        .groupBy(*by, "draw")
        .agg(F.count(F.lit(1)).alias("_n"), weighted.alias("_mean"))
    )
    tail = (1 - level) / 2
    resample = F.when(~own, F.col("_mean"))
    found = means.groupBy(*by).agg(
        F.max(F.when(own, F.col("_n"))).alias("n"),
        F.max(F.when(own, F.col("_mean"))).alias("mean"),
        F.percentile(resample, F.lit(tail)).alias("low"),
        F.percentile(resample, F.lit(1 - tail)).alias("high"),
    )
    return found.where("n > 0")
