"""Layout-independent pseudo-random choice.

``DataFrame.sample`` and ``randomSplit`` depend on how rows fall into partitions, so the same
call can pick other rows after a repartition or a lost executor. Hashing the key gives every
row its own fixed draw, and a split becomes a plain filter: no shuffle, no stored row list.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

HASH_RANGE = 1 << 32


def key_hash(*keys: Column | str, salt: str = "") -> Column:
    """Uniform integer in [0, 2**32): leading 32 bits of md5 over ``salt:key:key...``."""
    parts = [F.lit(salt)] if salt else []
    parts += [(F.col(k) if isinstance(k, str) else k).cast("string") for k in keys]
    digest = F.md5(F.concat_ws(":", *parts).cast("binary"))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")


def threshold(share: float) -> int:
    """Hash values below this make up ``share`` of all keys."""
    return int(round(share * HASH_RANGE))


def drawn(share: float, *keys: Column | str, salt: str = "") -> Column:
    """True for about ``share`` of the keys."""
    return key_hash(*keys, salt=salt) < F.lit(threshold(share))


def spread(n: Column | int, *keys: Column | str) -> Column:
    """Bucket in [0, n) from all keys; only for physical layout, never visible in results."""
    width = F.lit(n) if isinstance(n, int) else n
    hashed = F.xxhash64(*[F.col(k) if isinstance(k, str) else k for k in keys])
    return F.pmod(hashed, width.cast("bigint")).cast("int")
