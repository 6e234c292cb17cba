"""Implicit ALS: fitting, saving, loading, and the parameter grid.

A grid search commits every point as it finishes and looks up what is committed before it starts, so
queries over the same data share their fits and a killed search goes on where it was.
"""

from __future__ import annotations

import itertools
import time
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import DataFrame, SparkSession

from earshot.operators import task_als
from earshot.operators.metrics import mean_average_precision
from earshot.operators.recommend import LIST_LENGTH, recommend
from earshot.session import freeing_shuffles, held, scratch_root
from earshot.sources.gridstore import GridStore, fingerprint, row_mark
from earshot.sources.versions import current_path

# The parameter grid, the sample share, and the directory name of a saved model.
RANKS = (5, 10, 20, 30, 50, 80)
REGS = (0.01, 0.1, 1.0)
ALPHAS = (0.1, 1.0, 5.0)
TRAIN_SHARE = 0.02
MODEL_NAME = "model_reg_{reg}_rank{rank}_a_{alpha}_{share}"

CHECKPOINT_EVERY = 2  # iterations after which the factors are written, so that the shuffles behind them can go
MOST_AT_ONCE = 16  # grid points under way together; each is a chain of short jobs
ROWS_PER_CORE = 1_000_000  # ratings of all points under way, as each holds a copy of its own
ROWS_PER_BLOCK = 100_000  # ratings worth a block of their own in a grid search


@dataclass(frozen=True)
class Params:
    rank: int
    reg: float
    alpha: float


def grid(ranks=RANKS, regs=REGS, alphas=ALPHAS) -> list[Params]:
    """One grid for training and for evaluation, rank varying slowest."""
    return [Params(*point) for point in itertools.product(ranks, regs, alphas)]


def fit_als(
    train: DataFrame, params: Params, seed: int = 1, blocks: int | None = None, iterations: int = 10, in_task: bool = False
) -> ALSModel | task_als.TaskModel:
    """Fit on (user_index, item_index, count), in as many blocks as the cluster has cores unless told.

    ``in_task`` is for ratings that fit a task, as ``fits_task`` tells: the same equations without a shuffle.
    """
    if in_task:
        return task_als.fit(train, params.rank, params.reg, params.alpha, seed, iterations)
    blocks = blocks or train.sparkSession.sparkContext.defaultParallelism
    scratch_root(train.sparkSession)  # ALS checkpoints there, which keeps its lineage short
    als = ALS(
        userCol="user_index",
        itemCol="item_index",
        ratingCol="count",
        implicitPrefs=True,
        rank=params.rank,
        regParam=params.reg,
        alpha=params.alpha,
        seed=seed,
        numUserBlocks=blocks,
        numItemBlocks=blocks,
        maxIter=iterations,
        checkpointInterval=CHECKPOINT_EVERY,
    )
    with freeing_shuffles(train.sparkSession):
        return als.fit(train)


def model_path(root: str, params: Params, share: float) -> str:
    name = MODEL_NAME.format(reg=params.reg, rank=params.rank, alpha=params.alpha, share=share)
    return f"{root}/{name}"


def save_model(model, path: str) -> None:
    """Overwrite; also for classifiers and pipelines."""
    if hasattr(model, "save_tables"):
        model.save_tables(path)
    else:
        model.write().overwrite().save(path)


def load_als(path: str) -> ALSModel:
    """The model at ``path``, or its current version where versions were published."""
    return ALSModel.load(current_path(SparkSession.active(), path))


def load_factors(spark: SparkSession, path: str, side: str = "item") -> DataFrame:
    """(id, features) straight from a model directory; ``side`` is ``item`` or ``user``."""
    return spark.read.parquet(f"{current_path(spark, path)}/{side}Factors")


BOARD = "position int, rank int, reg double, alpha double, map double, coverage double, fit_seconds double, score_seconds double"


def train_grid(train: DataFrame, points: list[Params], root: str, share: float = 1.0, **fit) -> None:
    """Fit and save a model for every grid point over one cached frame."""
    train = train.select("user_index", "item_index", "count").persist(StorageLevel.MEMORY_AND_DISK)
    try:
        n = train.count()
        fit["blocks"] = fit.get("blocks") or _blocks(train, n)
        save = lambda p: save_model(fit_als(train, p, **fit), model_path(root, p, share))
        together(train.sparkSession, save, _longest_first(points), fit["blocks"], _fits_at_once(train, n))
    finally:
        train.unpersist()


def evaluate_grid(labels: DataFrame, points: list[Params], root: str, share: float = 1.0, k: int = LIST_LENGTH) -> DataFrame:
    """Leaderboard of saved models on held-out labels."""
    labels = labels.select("user_index", "item_index").persist(StorageLevel.MEMORY_AND_DISK)
    try:
        rows = together(labels.sparkSession, lambda p: _score(labels, p, lambda: load_als(model_path(root, p, share)), k), points, 1)
    finally:
        labels.unpersist()
    return _board(labels.sparkSession, points, rows)


def grid_search(
    train: DataFrame, labels: DataFrame, points: list[Params], k: int = LIST_LENGTH, store: str | None = None, **fit
) -> DataFrame:
    """The same leaderboard, fitting without saving the models; points already committed are read.

    ``store`` is the folder of committed points, by default the one the session names.
    """
    spark = train.sparkSession
    # As tables that go afterwards: the plans of all points would hold a copy of the plan behind a cached frame.
    with held(train.select("user_index", "item_index", "count"), "grid-train") as train, held(labels.select("user_index", "item_index"), "grid-labels") as labels:
        n, mark = row_mark(train)
        fit["blocks"] = fit.get("blocks") or _blocks(train, n)
        here = {"in_task": True} if fits_task(n) else {}
        kept = GridStore(spark, fingerprint(mark, row_mark(labels)[1], k=k, **fit, **here), store)
        done = kept.points()

        def finish(params: Params) -> dict:
            row = _score(labels, params, lambda: fit_als(train, params, **fit, **here), k)
            kept.commit(_point_name(params), row)
            return row

        missing = _longest_first([p for p in points if _point_name(p) not in done])
        at_once = _fits_at_once(train, n)
        if here:  # each is one task, and while one is scored another fits
            at_once = min(at_once, spark.sparkContext.defaultParallelism + 2)
        found = together(spark, finish, missing, fit["blocks"], at_once)
        done.update(zip(map(_point_name, missing), found))
    return _board(spark, points, [done[_point_name(p)] for p in points])


def fits_task(rows: int) -> bool:
    """Whether so many ratings are few enough for one task to hold."""
    return rows <= ROWS_PER_CORE


def _point_name(params: Params) -> str:
    return f"rank{params.rank}_reg{params.reg}_a{params.alpha}"


def _blocks(train: DataFrame, rows: int) -> int:
    return max(1, min(-(-rows // ROWS_PER_BLOCK), train.sparkSession.sparkContext.defaultParallelism))


def _longest_first(points: list[Params]) -> list[Params]:
    """The highest ranks first, so that no long fit is left over at the end."""
    return sorted(points, key=lambda p: -p.rank)


def _fits_at_once(train: DataFrame, rows: int) -> int:
    """Fits under way, by the ratings they hold: a fit alone waits between its stages and leaves cores idle."""
    return max(2, min(MOST_AT_ONCE, train.sparkSession.sparkContext.defaultParallelism * ROWS_PER_CORE // max(rows, 1)))


def together(spark: SparkSession, work: Callable, points: list, blocks: int, at_once: int | None = None) -> list:
    """``work`` of every point, as many at once as told or as their blocks leave cores; results in order.

    A point that fails ends the search after those under way; what is finished stays committed.
    """
    scratch_root(spark)  # set once, before threads need it
    at_once = at_once or max(2, min(MOST_AT_ONCE, spark.sparkContext.defaultParallelism // blocks))
    pool = ThreadPoolExecutor(at_once)
    try:
        return list(pool.map(inheritable_thread_target(spark)(work), points))
    finally:
        pool.shutdown(cancel_futures=True)


def _score(labels: DataFrame, params: Params, model_for: Callable[[], ALSModel], k: int) -> dict:
    """One leaderboard row; the lists are never written."""
    start = time.perf_counter()
    model = model_for()
    fitted = time.perf_counter()
    try:
        result = mean_average_precision(recommend(model.userFactors, model.itemFactors, labels, k), labels).first()
    finally:
        if isinstance(model, task_als.TaskModel):
            model.release()
    return {
        "map": result["map"],
        "coverage": result["coverage"],
        "fit_seconds": fitted - start,
        "score_seconds": time.perf_counter() - fitted,
    }


def _board(spark: SparkSession, points: list[Params], rows: list[dict]) -> DataFrame:
    values = [
        (i, p.rank, p.reg, p.alpha, r["map"], r["coverage"], r["fit_seconds"], r["score_seconds"])
        for i, (p, r) in enumerate(zip(points, rows))
    ]
    return spark.createDataFrame(values, BOARD)
