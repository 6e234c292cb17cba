"""Values per key as arrays, such as what each user interacted with."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from earshot.functions.hashing import key_hash

PARTS = 16


def collect_parts(
    df: DataFrame, key: str, value: str, output: str, entry: Column | None = None, parts: int = PARTS
) -> DataFrame:
    """(key, part, output): sorted arrays of the ``entry`` (default ``value``) of every key.

    ``df`` has one row per (key, value). Every value belongs to the part its hash names, whatever
    the key and its size, so a heavy key is collected by ``parts`` tasks and the shape of the
    result is the same at every scale. All parts of a key together hold every value;
    ``parts=1`` gives one row per key.
    """
    part = (key_hash(value, salt="part") % parts).cast("int").alias("part")
    entry = F.col(value) if entry is None else entry
    return df.groupBy(key, part).agg(F.array_sort(F.collect_list(entry)).alias(output))


def user_histories(df: DataFrame, user: str = "user_index", item: str = "item_index", parts: int = PARTS) -> DataFrame:
    """(user, part, label): the user's distinct items, sorted."""
    return collect_parts(df.select(user, item).distinct(), user, item, "label", parts=parts)
