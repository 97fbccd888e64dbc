"""Parameters by grid: the parallel scan against the sequential recursion."""

import datetime as dt
import math
import random

import pytest

from flowlab.operators import forecast as fc
from flowlab.operators import smoothing as sg


def windows(spark, values, horizon=5, n=1):
    rows = [(k, dt.date(2020, 1, 1) + dt.timedelta(days=i), float(v)) for k, vs in values.items() for i, v in enumerate(vs)]
    return fc.backtest_windows(spark.createDataFrame(rows, "item_id string, ts date, target_value double"), horizon, n)


def series(seed, n):
    rng, level, out = random.Random(seed), 50.0, []
    for i in range(n):
        level += rng.gauss(0.1, 1)
        out.append(level + 9 * math.sin(2 * math.pi * i / 7) + rng.gauss(0, 2))
    return out


@pytest.mark.parametrize("kind", ["simple", "trend", "season"])
@pytest.mark.parametrize("size", [1, 5, 64, 100_000])
def test_the_scan_equals_the_recursion(spark, kind, size):
    values = {"a": series(1, 90), "b": series(2, 31), "short": [4.0, 5.0, 7.0, 1.0, 2.0, 3.0], "flat": [2.0] * 40}
    w = windows(spark, values)
    end = max(map(len, values.values()))
    got = {r.item_id: r for r in sg.fit_grid(w, kind, 7, size=size).collect()}
    for k, vs in values.items():
        train = vs[:end - 5]                                         # the windows end with the longest series
        best = min((sg.recursion(train, kind, p, 7)[0], i) for i, p in enumerate(sg.grid_points(kind)))
        r = got[k]
        assert math.isclose(r.sse, best[0], rel_tol=1e-9, abs_tol=1e-9)
        point = (r.alpha, r.beta, r.gamma)
        sse, state = sg.recursion(train, kind, point, 7)
        assert math.isclose(sse, best[0], rel_tol=1e-9, abs_tol=1e-9) and r.errors == len(train) - 1
        assert all(math.isclose(x, y, rel_tol=1e-9, abs_tol=1e-9) for x, y in zip(r.state, state))


def test_forecasts_of_fixed_points_equal_the_fixed_models(spark):
    w = windows(spark, {"a": series(3, 80), "b": series(4, 80)}, 9, 2)
    for kind, one, plain in (("simple", {"alpha": (0.3,)}, fc.forecast_ets(w, 9, alpha=0.3)), ("trend", {"alpha": (0.3,), "beta": (0.1,)}, fc.forecast_holt(w, 9, 0.3, 0.1)),
                             ("season", {"alpha": (0.3,), "beta": (0.1,), "gamma": (0.2,)}, fc.forecast_holt_winters(w, 9, 0.3, 0.1, 0.2, 7))):
        got = {(r.item_id, r.window, r.ts): r.value for r in sg.forecast_grid(w, 9, kind, 7, grid=one).where("quantile = 0.5").collect()}
        want = {(r.item_id, r.window, r.ts): r.value for r in plain.where("quantile = 0.5").collect()}
        assert set(got) == set(want) and all(math.isclose(got[k], want[k], rel_tol=1e-9) for k in want)


def test_the_grid_is_no_worse_and_intervals_widen(spark):
    w = windows(spark, {f"i{k}": series(k, 200) for k in range(4)}, 14, 2)
    f = sg.forecast_grid(w, 14, "season", 7)
    rows = {(r.item_id, r.window, r.step, r.quantile): r.value for r in f.collect()}
    assert len(rows) == 4 * 2 * 14 * 3
    for k in range(4):
        width = [rows[f"i{k}", 1, h, 0.9] - rows[f"i{k}", 1, h, 0.1] for h in range(1, 15)]
        assert width[0] > 0 and all(a <= b + 1e-9 for a, b in zip(width, width[1:]))
    loss = {r.algorithm: r.avg_wQL for r in fc.evaluate(f.unionByName(fc.forecast_seasonal_naive(w, 14)), w).groupBy("algorithm").avg("avg_wQL").withColumnRenamed("avg(avg_wQL)", "avg_wQL").collect()}
    assert loss["HoltWintersGrid"] < loss["SeasonalNaive"]
    assert sg.fit_grid(w.limit(0), "season", 7).collect() == []
