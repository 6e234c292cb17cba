"""Side tables written in the same buckets of one key, sorted, so that joining them shuffles nothing.

The number of buckets follows the largest table's counted rows and is the same for all. Each bucket
is one file, sorted so that scans can skip parts of it, and a join reads the same bucket of every table. Tables have one row per key: a key with many
rows is aggregated before it is written, so no bucket depends on how hot a key is.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from earshot.session import remove_path, scratch_path

ROWS_PER_BUCKET = 1_000_000


@dataclass(frozen=True)
class Colocated:
    """Tables by name, bucketed by ``key``; ``drop`` removes them when nothing reads them any more."""

    spark: SparkSession
    key: str
    names: dict[str, str]  # catalog names
    folder: str

    def table(self, name: str) -> DataFrame:
        return self.spark.table(self.names[name])

    def joined(self) -> DataFrame:
        """Inner join of all tables in their order, without an exchange."""
        first, *rest = self.names
        found = self.table(first)
        for name in rest:
            found = found.join(self.table(name).hint("merge"), self.key)
        return found

    def drop(self) -> None:
        for name in self.names.values():
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        remove_path(self.spark, self.folder)


def colocate(parts: dict[str, DataFrame], key: str, rows_per_bucket: int = ROWS_PER_BUCKET) -> Colocated:
    """Write the tables, each one row per ``key``; rows without a key are left out, as a join would do.

    Pass stored tables: each is counted before it is written.
    """
    spark = next(iter(parts.values())).sparkSession
    kept = {name: df.where(F.col(key).isNotNull()) for name, df in parts.items()}
    buckets = max(1, -(-max(df.count() for df in kept.values()) // rows_per_bucket))
    folder, mark = scratch_path(spark, "colocated"), uuid.uuid4().hex
    names = {}
    for name, df in kept.items():
        names[name] = f"colocated_{name}_{mark}"
        writer = df.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key)
        writer.option("path", f"{folder}/{name}").saveAsTable(names[name])
    return Colocated(spark, key, names, folder)
