"""Dense integer ids for string keys, most frequent first."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from earshot.operators.skew import lookup_join
from earshot.session import stored


def fit_index(df: DataFrame, key: str, index: str) -> DataFrame:
    """(key, index, freq): ids 0..n-1 by row count descending, ties by the key as text.

    No label list passes through the driver, and a hot key is counted map-side before the shuffle.
    """
    counts = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("freq"))
    ordered = counts.orderBy(F.desc("freq"), F.col(key).cast("string"))
    return number_rows(ordered, index, f"index-{key}").select(key, index, "freq")


def number_rows(ordered: DataFrame, index: str, name: str) -> DataFrame:
    """Sorted rows with their position 0..n-1 in ``index``; ``name`` is for the scratch table.

    The numbering is one distributed sort: each sorted partition numbers its own rows, and the
    partition sizes (one row per partition) give the offset of each. The sorted table is written
    before the offsets are taken, so both come from the same sort.
    """
    row_in_part = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    numbered = stored(
        ordered.select("*", F.spark_partition_id().alias("part"), row_in_part.alias("pos")),
        name,
    )
    sizes = numbered.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # rows = partitions
    offsets = sizes.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    return numbered.join(F.broadcast(offsets), "part").select(
        *ordered.columns, (F.col("offset") + F.col("pos")).cast("int").alias(index)
    )


def apply_index(df: DataFrame, index_table: DataFrame, key: str, unseen: str = "skip") -> DataFrame:
    """Add the index column. Unseen and null keys are dropped (``skip``) or raise (``error``)."""
    if unseen == "skip":
        return lookup_join(df, index_table.drop("freq"), key)
    index = next(c for c in index_table.columns if c not in (key, "freq"))
    joined = lookup_join(df, index_table.drop("freq"), key, how="left")
    message = F.concat(F.lit(f"unseen {key}: "), F.coalesce(F.col(key).cast("string"), F.lit("null")))
    checked = F.when(F.col(index).isNull(), F.raise_error(message)).otherwise(F.col(index))
    return joined.withColumn(index, checked.cast("int"))


def index_pairs(df: DataFrame, users: DataFrame, items: DataFrame) -> DataFrame:
    """Interactions with both indexes; rows with a key unseen in either are dropped."""
    return apply_index(apply_index(df, users, "user_id"), items, "track_id")
