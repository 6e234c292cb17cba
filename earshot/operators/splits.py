"""Samples and hold-outs, all decided by hashed keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from earshot.functions.hashing import drawn, key_hash, threshold
from earshot.operators.skew import lookup_join

VALID_SHARE = 0.01
TEST_SHARE = 0.09


def hash_sample(df: DataFrame, share: float, *keys: str, salt: str = "sample") -> DataFrame:
    """About ``share`` of the rows."""
    return df.where(drawn(share, *keys, salt=salt))


def holdout_histories(
    df: DataFrame,
    valid: float = VALID_SHARE,
    test: float = TEST_SHARE,
    hidden: float = 0.5,
    user: str = "user_id",
    item: str = "track_id",
) -> DataFrame:
    """Add ``split``: full histories of most users plus partial ones of held-out users are train.

    A user's hash puts the user among validation, test or training users; for the first two, the
    row's hash decides which part of the history is hidden. A projection, so nothing is shuffled.
    """
    group = key_hash(user, salt="holdout-user")
    kind = F.when(group < threshold(valid), "valid").when(group < threshold(valid + test), "test")
    hide = drawn(hidden, user, item, salt="holdout-row")
    return df.withColumn("split", F.coalesce(F.when(hide, kind), F.lit("train")))


def sample_with_users(
    df: DataFrame, keep_users: DataFrame, share: float, user: str = "user_id", item: str = "track_id"
) -> DataFrame:
    """Sample rows, but keep every row of ``keep_users`` so that evaluation stays possible."""
    keep = keep_users.select(user).distinct().withColumn("_kept", F.lit(True))
    tagged = lookup_join(df, keep, user, how="left")
    return tagged.where(F.col("_kept") | drawn(share, user, item, salt="sample")).drop("_kept")


def split_rows(df: DataFrame, share: float, *keys: str, salt: str = "part") -> tuple[DataFrame, DataFrame]:
    """(rest, drawn part of about ``share``); the same rows every time, whatever the layout."""
    chosen = drawn(share, *keys, salt=salt)
    return df.where(~chosen), df.where(chosen)


def hold_out_items(df: DataFrame, share: float, item: str = "track_id") -> tuple[DataFrame, DataFrame]:
    """(interactions of kept items, interactions of held-out items) for a cold-start trial."""
    return split_rows(df, share, item, salt="cold-item")


def sample_queries(df: DataFrame, n: int, key: str = "id", salt: str = "query") -> DataFrame:
    """``n`` distinct rows in hash order."""
    return df.orderBy(key_hash(key, salt=salt), key).limit(n)
