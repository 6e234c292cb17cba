"""The store of finished grid points: shared, resumed, never mixed up."""

import pytest
from pyspark.sql import functions as F

from earshot.operators import models
from earshot.sources.gridstore import GridStore, fingerprint, row_mark

POINTS = models.grid((2, 3), (0.1,), (1.0, 5.0))
FIT = {"iterations": 2}


@pytest.fixture(scope="module")
def data(spark):
    rows = [(u, (u * 7 + i * i) % 23, float(1 + (u + i) % 4)) for u in range(30) for i in range(8)]
    train = spark.createDataFrame(rows, "user_index int, item_index int, count double")
    return train, train.where("user_index % 3 = 0").select("user_index", "item_index")


def scores(board):
    return [tuple(r)[:6] for r in board.orderBy("position").collect()]


def no_fit(*args, **kwargs):
    raise AssertionError("fitted again")


def test_points_are_fitted_once_and_read_afterwards(data, tmp_path, monkeypatch):
    train, labels = data
    first = models.grid_search(train, labels, POINTS, 5, str(tmp_path), **FIT)
    assert [r[1:4] for r in scores(first)] == [(p.rank, p.reg, p.alpha) for p in POINTS]
    monkeypatch.setattr(models, "fit_als", no_fit)
    again = models.grid_search(train.repartition(5), labels, POINTS[::-1], 5, str(tmp_path), **FIT)
    assert [r[1:] for r in scores(again)] == [r[1:] for r in scores(first)][::-1]


def test_a_killed_search_goes_on_where_it_was(data, tmp_path, monkeypatch):
    train, labels = data
    fit, fitted = models.fit_als, []

    def fails(train, params, **settings):
        if params == POINTS[-1]:
            raise RuntimeError("killed")
        fitted.append(params)
        return fit(train, params, **settings)

    monkeypatch.setattr(models, "fit_als", fails)
    with pytest.raises(RuntimeError, match="killed"):
        models.grid_search(train, labels, POINTS, 5, str(tmp_path), **FIT)
    before = list(fitted)
    monkeypatch.setattr(models, "fit_als", lambda train, params, **s: fitted.append(params) or fit(train, params, **s))
    board = models.grid_search(train, labels, POINTS, 5, str(tmp_path), **FIT)
    assert board.count() == len(POINTS) and before
    assert sorted(fitted, key=str) == sorted(POINTS, key=str)  # nothing twice


@pytest.mark.parametrize("change", ["rows", "labels", "k", "iterations"])
def test_other_data_or_settings_find_nothing(data, tmp_path, monkeypatch, change):
    train, labels = data
    models.grid_search(train, labels, POINTS[:1], 5, str(tmp_path), **FIT)
    monkeypatch.setattr(models, "fit_als", no_fit)
    settings = {**FIT, "iterations": 3} if change == "iterations" else FIT
    if change == "rows":
        train = train.withColumn("count", F.log10(F.col("count") + 1))
    if change == "labels":
        labels = labels.where("item_index > 3")
    with pytest.raises(AssertionError, match="fitted again"):
        models.grid_search(train, labels, POINTS[:1], 6 if change == "k" else 5, str(tmp_path), **settings)


def test_the_first_commit_stays_and_drafts_are_not_read(spark, tmp_path):
    store = GridStore(spark, "x", str(tmp_path))
    assert store.points() == {}
    store.commit("a", {"map": 1.0})
    store.commit("a", {"map": 2.0})
    (tmp_path / "x" / "_b-unfinished").write_text('{"map"')
    assert store.points() == {"a": {"map": 1.0}}


def test_marks_depend_on_rows_and_not_on_layout(spark):
    rows = spark.createDataFrame([(1, 2.0), (1, 2.0), (3, None)], "a int, b double")
    assert row_mark(rows) == row_mark(rows.repartition(3))
    assert row_mark(rows) != row_mark(rows.distinct())
    assert row_mark(rows.limit(0))[0] == 0
    assert fingerprint("m", k=1) != fingerprint("m", k=2)
