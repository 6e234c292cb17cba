"""Hard negatives against plain inner products over all pairs."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from earshot.llm import negatives
from earshot.llm.queries import QUERIES

SCHEMA = "vec_id long, embedding array<float>, label int, score long, row long"


def brute(rows, anchor=lambda i: i % 10 == 0, n=5):
    taken = []
    for i, v, label, *_ in rows:
        if label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        taken.append((i, [math.floor(256 * float(np.float32(x))) for x in v], label))
    order = lambda scored: sorted(scored, key=lambda t: (-t[0], t[1] is None, t[1] or 0))
    out = []
    for a, (i, v, label) in enumerate(taken):
        if i is None or not anchor(i):
            continue
        scored = [(sum(p * q for p, q in zip(v, w)), j, other) for b, (j, w, other) in enumerate(taken) if b != a]
        positives = order([t for t in scored if t[2] == label])[:n]
        others = order([t for t in scored if t[2] != label])
        for ps, pid, _ in positives:
            near = [t for t in others if 80 * ps <= 100 * t[0] <= 100 * ps][:n]
            out += [(i, pid, rank, t[1], ps, t[0]) for rank, t in enumerate(near, 1)]
    return sorted(out, key=str)


def mined(spark, rows, **options):
    df = spark.createDataFrame(rows, SCHEMA)
    return sorted(map(tuple, negatives.mine(df, F.col("vec_id") % 10 == 0, **options).collect()), key=str)


@pytest.mark.parametrize("scale", [1.0, 500.0, 60000.0])
def test_packed_products_are_exact(scale):
    draw = np.random.default_rng(3)
    for rows in (1, 7, negatives.FIELDS, negatives.FIELDS + 3):
        items = np.floor(256 * scale * draw.normal(size=(rows, 12))).astype(np.int64)
        anchors = np.floor(256 * scale * draw.normal(size=(4, 12))).astype(np.int64)
        bias = int(max(0, -anchors.min()))
        packed = negatives.Packed(items, (anchors + bias).max(0))
        for anchor in anchors:
            assert (packed.scores(anchor, bias) == items @ anchor).all()


def test_fields_widen_with_the_range():
    widths = [negatives.Packed(np.array([[1 << b, -5]]), np.array([1 << b, 1])).width for b in (8, 20, 33)]
    assert widths == [4, 8, 16]


def test_against_brute_force(spark):
    draw = np.random.default_rng(5)
    centres = draw.normal(size=(4, 8))
    rows = [(i, [float(x) for x in centres[i % 3] + 0.4 * draw.normal(size=8)], int(draw.integers(4)), 0, 0) for i in range(300)]
    rows += [(400 + i, [0.5] * 8, i % 2, 0, 0) for i in range(60)]  # ties
    want = brute(rows)
    assert len(want) > 300
    assert mined(spark, rows) == want
    assert mined(spark, rows, anchor_block=7, item_block=11) == want


def test_awkward_rows(spark):
    rows = [
        (0, [1.0, 0.5], 1, None, 3),
        (0, [1.0, 0.5], 1, None, 3),  # a repeated anchor
        (None, [1.0, 0.5], 1, 1, None),
        (None, [1.0, 0.4], 2, 1, 1),
        (10, [0.0, 0.0], 1, 1, 1),
        (20, [], 1, 1, 1),
        (30, None, 1, 1, 1),
        (40, [1.0, None], 1, 1, 1),
        (50, [float("nan"), 1.0], 1, 1, 1),
        (60, [float("inf"), 1.0], 1, 1, 1),
        (70, [1.0, 0.5], None, 1, 1),
        (3, [1.0, 0.4], 2, 1, 1),
        (3, [1.0, 0.4], 2, 1, 1),
        (80, [-1.0, -0.5], 2, 1, 1),
        (7, [0.25], 3, 1, 1),
    ]
    want = brute([(i, v if v is None else [*v, 0.0, 0.0][:2], label) for i, v, label, *_ in rows])
    assert want and mined(spark, rows) == want
    assert mined(spark, []) == []
    assert mined(spark, rows[2:4]) == []


def test_scores_beyond_64_bits_are_refused(spark):
    rows = [(i, [1e16, 1e16], i % 2, 0, 0) for i in range(0, 40, 10)]
    with pytest.raises(Exception, match="64 bits"):
        mined(spark, rows)


def test_query_equals_its_sql_at_more_than_one_block(spark, data):
    """The registered query, over blocks so small that every pair of blocks matters."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = spark.read.parquet(f"{data}/embeddings.parquet")
    cut = negatives.mine(vectors, F.col("vec_id") % 100 == 0, label=moved, anchor_block=2, item_block=37)
    assert sorted(map(tuple, cut.collect())) == sorted(map(tuple, QUERIES["op12_hard_negatives"](spark, data).collect()))
