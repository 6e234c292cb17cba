"""Ranking metrics and classification error, as plain aggregations.

Everything works on long tables, one row per (user, item). The only join is on the pair, so a
user or an item that holds a large part of all rows is spread over many tasks, and each user
contributes at most one row per recommended position to the per-user steps.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def per_user_metrics(
    lists: DataFrame, labels: DataFrame, ks: tuple[int, ...] = (), by: tuple[str, ...] = ()
) -> DataFrame:
    """One row per scored user (one that has a list and labels).

    ``ap`` sums precision at every hit over the number of distinct labels; ``ap_at_k`` divides by
    min(labels, k), ``precision_at_k`` by k, ``recall_at_k`` by the labels; ``ndcg_at_k`` has
    binary gains. ``by`` names extra list columns, such as the model, to be scored side by side.
    ``lists`` is read twice, so store lists that are expensive to compute.

    Lists without a ``user_index`` are the same for everybody, such as the most popular items: all
    users with labels are scored, and the entries are matched with the labels as they are.
    """
    who = [*by, "user_index"]
    wanted = labels.select("user_index", "item_index").distinct()
    sizes = wanted.groupBy("user_index").agg(F.count("item_index").alias("n_labels"))  # null item: none
    common = "user_index" not in lists.columns
    shared = ["item_index"] if common else ["user_index", "item_index"]
    found = wanted.join(lists.select(*by, *shared, "position"), shared)
    nth = F.row_number().over(Window.partitionBy(*who).orderBy("position"))
    gains = found.withColumn("precision", nth / F.col("position"))

    sums = [F.sum("precision").alias("sum_all"), F.count(F.lit(1)).alias("hits")]
    for k in ks:
        inside = F.col("position") <= k
        sums += [
            F.sum(F.when(inside, F.col("precision"))).alias(f"sum_{k}"),
            F.count(F.when(inside, 1)).alias(f"hits_{k}"),
            F.sum(F.when(inside, 1 / F.log2(F.col("position") + 1))).alias(f"dcg_{k}"),
        ]
    scored = _everyone(lists, sizes, by) if common else lists.select(*who).distinct().join(sizes, "user_index")
    users = scored.join(gains.groupBy(*who).agg(*sums), who, "left")

    n = F.col("n_labels")
    columns = [*who, "n_labels", F.coalesce("hits", F.lit(0)).alias("hits"), _share("sum_all", n).alias("ap")]
    for k in ks:
        ideal = F.aggregate(
            F.sequence(F.lit(1), F.least(n, F.lit(k)).cast("int")),
            F.lit(0.0),
            lambda total, i: total + 1 / F.log2(i + 1),
        )
        columns += [
            _share(f"sum_{k}", F.least(n, F.lit(k))).alias(f"ap_at_{k}"),
            _share(f"hits_{k}", F.lit(k)).alias(f"precision_at_{k}"),
            _share(f"hits_{k}", n).alias(f"recall_at_{k}"),
            _share(f"dcg_{k}", ideal).alias(f"ndcg_at_{k}"),
        ]
    return users.select(*columns)


def _everyone(lists: DataFrame, sizes: DataFrame, by: tuple[str, ...]) -> DataFrame:
    """Every user once for each common list; for none when there is no list."""
    groups = lists.agg(F.collect_set(F.struct(F.lit(1).alias("_"), *by))).scalar()
    rows = sizes.withColumn("_groups", groups).select(*sizes.columns, F.explode("_groups").alias("_group"))
    return rows.select(*[F.col("_group")[c].alias(c) for c in by], *sizes.columns)


def _share(total: str, whole: Column) -> Column:
    """total / whole, and 0 for users without labels or hits."""
    return F.when(F.col("n_labels") > 0, F.coalesce(F.col(total), F.lit(0)) / whole).otherwise(F.lit(0.0))


def ranking_metrics(
    lists: DataFrame, labels: DataFrame, ks: tuple[int, ...] = (), by: tuple[str, ...] = ()
) -> DataFrame:
    """Means over the scored users, one row (per ``by`` group).

    ``users`` is how many were scored and ``coverage`` their share of all users with labels;
    ``map_all_users`` counts the users without a list as 0.
    """
    per_user = per_user_metrics(lists, labels, ks, by)
    with_labels = labels.select(F.count_distinct("user_index")).scalar()
    means = [F.avg("ap").alias("map")]
    for k in ks:
        means.append(F.avg(f"ap_at_{k}").alias(f"map_at_{k}"))
        means += [F.avg(f"{m}_at_{k}").alias(f"{m}_at_{k}") for m in ("precision", "recall", "ndcg")]
    means.append(F.count(F.lit(1)).alias("users"))
    result = per_user.groupBy(*by).agg(*means).withColumn("coverage", F.col("users") / with_labels)
    return result.withColumn("map_all_users", F.col("map") * F.col("coverage"))


def mean_average_precision(lists: DataFrame, labels: DataFrame) -> DataFrame:
    """(map, users, coverage), as ``ranking_metrics`` gives them, in one pass over ``lists``.

    The lists are matched with the labels on the pair and reduced to the positions of the hits, at
    most one list's length per user, so they need not be stored to be scored.
    """
    wanted = labels.select("user_index", "item_index").distinct()
    sizes = wanted.groupBy("user_index").agg(F.count("item_index").alias("n_labels"))
    hit = F.when(F.col("hit"), F.col("position"))
    matched = lists.select("user_index", "item_index", "position").join(
        wanted.withColumn("hit", F.lit(True)), ["user_index", "item_index"], "left"
    )
    positions = matched.groupBy("user_index").agg(F.array_sort(F.collect_list(hit)).alias("at")).join(sizes, "user_index")
    precision = F.aggregate(F.transform("at", lambda p, i: (i + 1) / p), F.lit(0.0), lambda total, x: total + x)
    ap = F.when(F.col("n_labels") > 0, precision / F.col("n_labels")).otherwise(0.0)
    users = F.count(F.lit(1))
    return positions.agg(F.avg(ap).alias("map"), users.alias("users")).withColumn(
        "coverage", F.col("users") / labels.select(F.count_distinct("user_index")).scalar()
    )


def error_rate(predictions: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """(errors, n, error_rate) of a classification."""
    wrong = F.col(label).cast("double") != F.col(prediction).cast("double")
    return predictions.agg(
        F.count(F.when(wrong, 1)).alias("errors"),
        F.count(F.lit(1)).alias("n"),
        F.avg(wrong.cast("double")).alias("error_rate"),
    )


def best_row(board: DataFrame, score: str, position: str = "position") -> DataFrame:
    """The row with the highest score; the earliest position wins ties."""
    return board.where(F.col(score).isNotNull()).orderBy(F.desc(score), position).limit(1)
