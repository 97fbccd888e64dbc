"""Changes of slope by a lasso over hinges."""

import datetime as dt
import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from flowlab.operators import changepoints as cp
from flowlab.operators import forecast as fc


def windows(spark, values, horizon=28, n=1):
    rows = [(k, dt.date(2018, 1, 1) + dt.timedelta(days=i), float(v)) for k, vs in values.items() for i, v in enumerate(vs)]
    return fc.backtest_windows(spark.createDataFrame(rows, "item_id string, ts date, target_value double"), horizon, n)


def bent(n, at, slope, seed, noise=1.0):
    rng = np.random.default_rng(seed)
    return [100 + 0.05 * i + slope * max(i - at, 0) + 5 * math.sin(2 * math.pi * i / 7) + rng.normal(0, noise) for i in range(n)]


def test_a_planted_change_of_slope_is_found(spark):
    n, at = 728 + 28, 392                                            # the knot after 7 of 13 parts of 80 % of the history
    w = windows(spark, {"bent": bent(n, at, 0.6, 1), "straight": bent(n, at, 0.0, 2)})
    fit, _, cols = cp.fit_changepoints(w, knots=12)
    beta = {r.item_id: np.array(r.beta)[len(cols):] for r in fit.collect()}
    knots = cp.SPREAD * (np.arange(12) + 1) / 13 * 727
    near = np.abs(knots - at) < 60
    per_day = beta["bent"] / 727
    assert abs(per_day[near].sum() - 0.6) < 0.12 and np.abs(per_day[~near]).sum() < 0.2
    assert np.abs(beta["straight"] / 727).sum() < 0.1


def test_forecasts_follow_the_last_slope_and_lose_less(spark):
    values = {f"i{k}": bent(700, 300 + 40 * k, 0.3 * (-1) ** k, k) for k in range(4)}
    w = windows(spark, values, 28, 2)
    a, b = cp.forecast_changepoints(w, 28), fc.forecast_harmonic(w, 28)
    loss = {r[0]: r[1] for r in fc.evaluate(a.unionByName(b), w).groupBy("algorithm").avg("avg_wQL").collect()}
    assert loss["Changepoints"] < loss["Harmonic"]
    assert a.count() == 4 * 2 * 28 * 3
    assert cp.forecast_changepoints(w.limit(0), 28).collect() == []
    flat = windows(spark, {"flat": [7.0] * 200, "short": [1.0, 2.0]}, 14)
    got = cp.forecast_changepoints(flat, 14).where("item_id = 'flat' and quantile = 0.5").collect()
    assert len(got) == 14 and all(abs(r.value - 7.0) < 1e-3 for r in got)


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 6), st.integers(0, 10_000), st.sampled_from([0.0, 0.01, 0.3, 1.0]))
def test_lasso_meets_its_conditions(k, seed, penalty):
    rng = np.random.default_rng(seed)
    x, y = rng.normal(size=(40, k)) * 10 ** rng.uniform(-2, 2, k), rng.normal(size=40)
    g, t = (x.T @ x)[None], (x.T @ y)[None]
    b = cp.lasso(g, t, penalty)[0]
    size = np.sqrt(np.diag(g[0]))
    slope = (t[0] - g[0] @ b) / size                                 # of the scaled problem
    weight = penalty * np.abs(t[0] / size).max()
    assert (np.abs(slope) <= weight + 1e-6 * max(weight, 1)).all()
    on = b != 0
    assert np.allclose(slope[on], np.sign(b[on]) * weight, atol=1e-6 * max(weight, 1))
    if penalty == 1.0:
        assert np.abs(b * size).max() < 1e-9


def test_constant_columns_stay_at_zero():
    g = np.array([[[0.0, 0.0], [0.0, 4.0]]])
    assert cp.lasso(g, np.array([[0.0, 2.0]]), 0.0).tolist() == [[0.0, 0.5]]
