"""Session for local runs, and the shared scratch folder that cuts lineage."""

from __future__ import annotations

import gc
import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def local_session(app: str = "earshot", cores: str = "*", **conf) -> SparkSession:
    """A session for tests and benchmarks; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_root(spark: SparkSession) -> str:
    """The folder all executors can reach, as the session names it.

    Only a local session may fall back to a folder of its own: on a cluster a machine-local
    path would leave every executor with different files.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        if context.getCheckpointDir() is None:
            context.setCheckpointDir(root)
        return root
    if context.getCheckpointDir() is None:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="earshot-"))
    return context.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the scratch folder."""
    return f"{scratch_root(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a scratch table that nothing reads any more."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def stored(df: DataFrame, name: str, partition_by: str | None = None) -> DataFrame:
    """Write ``df`` as a scratch table and read it back.

    Used where several later steps read one expensive result: the plan is cut there, the result
    survives lost executors, and readers get column pruning and pushed-down filters.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    writer = df.write
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(path)
    columns = [df.schema[c] for c in df.columns if c != partition_by]
    if partition_by:
        columns.append(df.schema[partition_by])
    return spark.read.schema(type(df.schema)(columns)).parquet(path)


def free_shuffles(spark: SparkSession) -> None:
    """Let Spark remove the shuffle files of results that are gone; it does when the driver collects its garbage, which may be never."""
    gc.collect()
    spark._jvm.System.gc()


@contextmanager
def freeing_shuffles(spark: SparkSession, seconds: float = 15.0) -> Iterator[None]:
    """Call ``free_shuffles`` now and then while the block runs."""
    ended = threading.Event()

    def run() -> None:
        while not ended.wait(seconds):
            free_shuffles(spark)

    worker = threading.Thread(target=run, daemon=True)
    worker.start()
    try:
        yield
    finally:
        ended.set()
        worker.join()


@contextmanager
def held(df: DataFrame, name: str) -> Iterator[DataFrame]:
    """``df`` as a scratch table that goes when the block ends, for results that nobody reads later."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    try:
        yield df.sparkSession.read.schema(df.schema).parquet(path)
    finally:
        remove_path(df.sparkSession, path)
