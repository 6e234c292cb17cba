"""Joins of a large table with a per-key table, where one key may own a third of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from earshot.functions.hashing import spread
from earshot.session import stored

MAX_BROADCAST_ROWS = 1_500_000  # narrow rows, a key and an id: at most some 200 MB
MAX_BROADCAST_BYTES = 256 << 20
HOT_ROWS = 2_000_000  # a key with more rows is cut into parts of about this size


def is_small(df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS, max_bytes: int = MAX_BROADCAST_BYTES) -> bool:
    """Whether rows, and rows times their widest width, are within the bounds; one aggregate."""
    widths = [F.lit(16 * len(df.columns))]
    for name, kind in df.dtypes:
        if kind in ("string", "binary"):
            widths.append(F.coalesce(F.max(F.length(name)), F.lit(0)))
        elif kind.startswith("array"):
            widths.append(F.coalesce(F.max(F.size(name)), F.lit(0)) * 8)
    rows, width = df.agg(F.count(F.lit(1)), sum(widths[1:], widths[0])).first()
    return rows <= max_rows and rows * width <= max_bytes


def broadcast_if_small(df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """Broadcast hint when rows and bytes are within their bounds, else left to a shuffle join."""
    return F.broadcast(df) if is_small(df, max_rows) else df


def lookup_join(
    facts: DataFrame,
    lookup: DataFrame,
    key: str,
    how: str = "inner",
    max_broadcast: int = MAX_BROADCAST_ROWS,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Join ``facts`` with ``lookup``, which has one narrow row per ``key`` (inner or left).

    A lookup within the size bound is broadcast and the facts stay where they are. Beyond it the
    join shuffles: rows of hot keys are spread over as many parts as their number needs, the
    lookup row is copied to each part, and no task receives all rows of one key. Rows that are
    copies of each other hash alike; those are left to the adaptive skew join.
    """
    if is_small(lookup, max_broadcast):
        return facts.join(F.broadcast(lookup), key, how)
    n = F.count(F.lit(1))
    sizes = facts.groupBy(key).agg(F.ceil(n / hot_rows).cast("int").alias("_parts"))
    hot = stored(sizes.where(F.col(key).isNotNull() & (F.col("_parts") > 1)), f"hot-{key}")
    if hot.isEmpty():
        return facts.join(lookup, key, how)
    hot = broadcast_if_small(hot)
    parts = F.coalesce("_parts", F.lit(1))
    salted = facts.join(hot, key, "left").withColumn("_salt", spread(parts, *facts.columns))
    copies = lookup.join(hot, key, "left").withColumn("_salt", F.explode(F.sequence(F.lit(0), parts - 1)))
    return salted.drop("_parts").join(copies.drop("_parts"), [key, "_salt"], how).drop("_salt")
