import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from earshot.operators import bootstrap


def test_weights_are_poisson_and_independent_of_the_layout(spark):
    rows = spark.range(2000)
    drawn = bootstrap.resampled(rows, "id", draws=20)
    weights = {(r.id, r.draw): r.weight for r in drawn.collect()}
    again = bootstrap.resampled(rows.repartition(7), "id", draws=20)
    assert weights == {(r.id, r.draw): r.weight for r in again.collect()}
    seen = Counter(weights.values())
    seen[0] = 40000 - len(weights)
    for n in range(5):
        assert seen[n] / 40000 == pytest.approx(math.exp(-1) / math.factorial(n), abs=0.01)
    assert bootstrap.poisson_thresholds()[0] == round(2**32 / math.e) and max(bootstrap.poisson_thresholds()) < 2**32


def test_interval_of_a_mean(spark):
    values = spark.range(900).select("id", F.when(F.col("id") % 3 == 0, 1.0).otherwise(0.0).alias("hit"))
    got = bootstrap.mean_interval(values, "hit", "id", draws=200).first()
    assert got.n == 900 and got["mean"] == pytest.approx(1 / 3)
    spread = 1.96 * math.sqrt(2 / 9 / 900)  # of the normal approximation
    assert got.low == pytest.approx(1 / 3 - spread, abs=0.01) and got.high == pytest.approx(1 / 3 + spread, abs=0.01)


def test_interval_by_group_and_awkward_rows(spark):
    rows = [(1, "a", 2.0), (2, "a", 2.0), (3, "b", None), (4, None, 5.0), (4, None, 5.0)]
    df = spark.createDataFrame(rows, "id int, kind string, v double")
    got = {r.kind: (r.n, r["mean"], r.low, r.high) for r in bootstrap.mean_interval(df, "v", "id", by=("kind",)).collect()}
    assert got["a"] == (2, 2.0, 2.0, 2.0) and "b" not in got
    assert bootstrap.mean_interval(df.where("kind = 'b'"), "v", "id").count() == 0
