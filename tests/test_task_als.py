"""Implicit ALS in a task: the equations, and the grids that use it."""

import time

import numpy as np

from earshot import session
from earshot.operators import models, task_als
from earshot.operators.metrics import mean_average_precision
from earshot.operators.recommend import recommend
from earshot.plans import queries


def test_half_a_step_solves_the_normal_equations():
    rng = np.random.default_rng(3)
    own = np.repeat(np.arange(40), rng.integers(1, 25, 40))  # fewer and more ratings than factors
    other = rng.integers(0, 30, len(own))
    rating = rng.integers(-1, 6, len(own)).astype(np.float64)  # negative, none, positive
    y = rng.normal(size=(30, 8)).astype(np.float32)
    for reg in (0.0, 0.01, 1.0):
        got = task_als._half(y, task_als._groups(own, other, rating, 0.7), 40, reg)
        for row in range(40):
            v, r = y[other[own == row]].astype(float), rating[own == row]
            c = 0.7 * np.abs(r)
            left = y.T.astype(float) @ y + (v * c[:, None]).T @ v + reg * (r > 0).sum() * np.eye(8)
            want = np.linalg.solve(left, v.T @ np.where(r > 0, 1 + c, 0.0))
            np.testing.assert_allclose(got[row], want, rtol=2e-5, atol=2e-6)


def test_a_point_fitted_in_a_task_is_as_good_as_by_the_block_solver(spark, data):
    ready = queries._prepared(spark, data)
    train, labels = ready.train.cache(), ready.valid.cache()
    params = models.Params(4, 0.1, 1.0)
    here, blocks = models.fit_als(train, params, in_task=True), models.fit_als(train, params, blocks=2)
    for side in ("userFactors", "itemFactors"):
        assert {r.id for r in getattr(here, side).collect()} == {r.id for r in getattr(blocks, side).collect()}
    # Both minimise the same sum; starts differ, so the sums differ a little.
    loss = [_loss(train, m, params) for m in (here, blocks)]
    assert abs(loss[0] / loss[1] - 1) < 0.01
    found = [mean_average_precision(recommend(m.userFactors, m.itemFactors, labels, 50), labels).first()["coverage"] for m in (here, blocks)]
    assert found[0] == found[1]
    here.release()


def _loss(train, model, params):
    rows = train.select("user_index", "item_index", "count").toPandas()
    users, items = ({r.id: np.array(r.features, float) for r in f.collect()} for f in (model.userFactors, model.itemFactors))
    x, y = (np.stack([f[i] for i in sorted(f)]) for f in (users, items))
    at = [np.searchsorted(sorted(f), rows[c]) for f, c in ((users, "user_index"), (items, "item_index"))]
    c, dot = params.alpha * rows["count"].to_numpy(float), (x[at[0]] * y[at[1]]).sum(1)
    square = np.einsum("ij,ij->", x.T @ x, y.T @ y)  # of all pairs, as if none were preferred
    n = [np.bincount(a, minlength=len(f)) for a, f in zip(at, (x, y))]
    return square + ((1 + c) * (1 - dot) ** 2 - dot**2).sum() + params.reg * sum((m * (f**2).sum(1)).sum() for m, f in zip(n, (x, y)))


def test_large_grids_keep_the_block_solver(spark, tmp_path, monkeypatch):
    asked = []
    monkeypatch.setattr(models, "fit_als", lambda train, params, **s: asked.append(s.get("in_task", False)))
    monkeypatch.setattr(models, "_score", lambda labels, params, model_for, k: model_for() or dict.fromkeys(("map", "coverage", "fit_seconds", "score_seconds"), 0.0))
    rows = spark.createDataFrame([(1, 2, 3.0), (2, 2, 1.0)], "user_index int, item_index int, count double")
    models.grid_search(rows, rows, models.grid((2,), (0.1,), (1.0,)), store=str(tmp_path))
    monkeypatch.setattr(models, "ROWS_PER_CORE", 1)
    models.grid_search(rows, rows, models.grid((2,), (0.1,), (1.0,)), store=str(tmp_path))
    assert asked == [True, False]


def test_the_block_solver_lets_its_shuffles_go(spark, monkeypatch):
    """Factors are written every other iteration, and the driver's garbage is collected while a fit runs."""
    set_, freed = [], []
    monkeypatch.setattr(session, "free_shuffles", lambda spark: freed.append(1))
    monkeypatch.setattr(models.ALS, "fit", lambda self, train: set_.append(self.getCheckpointInterval()) or time.sleep(0.3))
    with session.freeing_shuffles(spark, 0.05):
        models.fit_als(spark.range(1), models.Params(2, 0.1, 1.0))
    assert set_ == [models.CHECKPOINT_EVERY] and freed
    n = len(freed)
    time.sleep(0.2)
    assert len(freed) == n
