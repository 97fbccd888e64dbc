"""ARIMA from one table of sums of products, and Shapley impacts, against plain refits."""

import datetime as dt
import itertools
import math

import numpy as np
import pytest

from flowlab.operators import arima as ar
from flowlab.operators import forecast as fc


def windows(spark, values, horizon=5, n=1, freq="day"):
    rows = [(k, dt.date(2010, 1, 4) + dt.timedelta(days=i * (7 if freq == "week" else 1)), None if v is None else float(v)) for k, vs in values.items() for i, v in enumerate(vs)]
    return fc.backtest_windows(spark.createDataFrame(rows, "item_id string, ts date, target_value double"), horizon, n, freq=freq)


def simulate(seed, n, phi, theta, c=0.0, d=1):
    rng = np.random.default_rng(seed)
    e, w = rng.normal(size=n + 1), np.zeros(n + 1)
    for t in range(1, n + 1):
        w[t] = c + phi * w[t - 1] + e[t] + theta * e[t - 1]
    for _ in range(d):
        w = w.cumsum()
    return w[1:]


def plain_fit(y, p, d, q, long, lags):
    """The two stages by least squares over the same points: coefficients, sum of squares, residuals."""
    w = np.diff(y, d) if d else np.asarray(y, float)
    w = np.concatenate([np.full(d, np.nan), w])
    t = np.arange(lags, len(y))
    e = np.full(len(y), np.nan)
    if q:
        x = np.stack([np.ones(len(t)), *(w[t - i] for i in range(1, long + 1))], 1)
        b = np.linalg.lstsq(x, w[t], rcond=None)[0]
        for s in range(long + d, len(y)):
            e[s] = w[s] - b[0] - sum(b[i] * w[s - i] for i in range(1, long + 1))
    x = np.stack([np.ones(len(t)), *(w[t - i] for i in range(1, p + 1)), *(e[t - j] for j in range(1, q + 1))], 1)
    b = np.linalg.lstsq(x, w[t], rcond=None)[0]
    return b, float(((w[t] - x @ b) ** 2).sum()), w, e


@pytest.mark.parametrize("order", [(1, 1, 1), (2, 0, 1), (0, 1, 2), (2, 1, 0), (0, 2, 1), (0, 1, 0)])
def test_one_table_equals_two_regressions(spark, order):
    p, d, q = order
    ys = {"a": simulate(1, 160, 0.5, 0.3, 0.1), "b": simulate(2, 160, -0.4, 0.6, d=0)}
    w = windows(spark, ys, 6)
    got = {}
    for r in ar.forecast_arima(w, 6, orders=[order], long=4, with_order=True).where("quantile = 0.5").collect():
        got.setdefault(r.item_id, {})[r.step] = r
    lags = max(p, 4 + q if q else 0) + d
    for k, y in ys.items():
        y = y[:-6]
        b, sse, diffs, e = plain_fit(y, p, d, q, 4, lags)
        assert np.allclose(got[k][1].coefficients, b, atol=1e-5)
        hist, errs, tail = list(diffs[::-1]), list(e[::-1]), [np.diff(y, i)[-1] if i else y[-1] for i in range(d)]
        for h in range(1, 7):
            nxt = b[0] + sum(b[i] * hist[i - 1] for i in range(1, p + 1)) + sum(b[p + j] * errs[j - 1] for j in range(1, q + 1))
            hist.insert(0, nxt)
            errs.insert(0, 0.0)
            level = nxt
            for i in range(d - 1, -1, -1):
                tail[i] += level
                level = tail[i]
            assert math.isclose(got[k][h].value, level, rel_tol=1e-4, abs_tol=1e-4)


def test_simulated_coefficients_and_order(spark):
    w = windows(spark, {"a": simulate(7, 4000, 0.6, 0.4)}, 5)
    r = ar.forecast_arima(w, 5, orders=[(1, 1, 1)], with_order=True).first()
    assert abs(r.coefficients[1] - 0.6) < 0.06 and abs(r.coefficients[2] - 0.4) < 0.08
    chosen = ar.forecast_arima(w, 5, max_p=1, max_q=1, with_order=True).first()     # (2, 0, 1) could hold the same model
    assert (chosen.p, chosen.d, chosen.q) == (1, 1, 1)
    still = windows(spark, {"a": simulate(8, 3000, 0.5, 0.0, 2.0, d=0)}, 5)
    assert ar.forecast_arima(still, 5, max_q=0, with_order=True).first().d == 0


def test_without_differences_and_errors_it_is_the_autoregression(spark):
    w = windows(spark, {"a": simulate(3, 120, 0.7, 0.0, 1.0, d=0), "b": simulate(4, 90, 0.2, 0.0, d=0)[:120]}, 7, 2)
    for p in (1, 3):
        got = {(r.item_id, r.window, r.ts, r.quantile): r.value for r in ar.forecast_arima(w, 7, orders=[(p, 0, 0)]).collect()}
        want = {(r.item_id, r.window, r.ts, r.quantile): r.value for r in fc.forecast_ar_p(w, 7, p).collect()}
        assert all(math.isclose(got[k], want[k], rel_tol=1e-6, abs_tol=1e-6) for k in got) and len(got) >= 42


def test_odd_series(spark):
    w = windows(spark, {"flat": [5.0] * 60, "short": [1.0, 2.0, 3.0], "gap": [None if i % 17 == 0 else float(i) for i in range(60)], "line": [2.0 * i for i in range(60)]}, 4)
    rows = ar.forecast_arima(w, 4, with_order=True).collect()
    at = {(r.item_id, r.step): r.value for r in rows if r.quantile == 0.5}
    assert "short" not in {k for k, _ in at} and all(math.isclose(at["flat", h], 5.0, abs_tol=1e-3) for h in range(1, 5))
    assert all(abs(at["line", h] - 2.0 * (55 + h)) < 0.5 for h in range(1, 5))
    assert ar.forecast_arima(w.limit(0), 4).collect() == []


def test_impacts_are_shapley_values_of_refits(spark):
    n = 800
    vals = [50 + 0.005 * i + 10 * math.sin(2 * math.pi * ((dt.date(2010, 1, 4) + dt.timedelta(days=i)).isoweekday() % 7 + 1) / 7) for i in range(n)]
    w = windows(spark, {"a": vals, "b": [v * 2 + (i * 7 % 5) for i, v in enumerate(vals)]}, 28, 2)
    cal = fc.holiday_calendar(spark, ("US",), 2009, 2013)
    rows = {r.attribute: r for r in fc.explain_impact(w, 28, cal).collect()}
    assert set(rows) == {"trend", "yearly_seasonality", "weekly_seasonality", "holiday"}
    assert max(rows.values(), key=lambda r: r.delta).attribute == "weekly_seasonality" and max(abs(r.impact) for r in rows.values()) == 1.0
    # every subset refitted by itself from the design's columns
    train = w.where("split = 'train'")
    x, cols = fc._design(train, 2, cal, "US")
    fut, _ = fc._design(fc._future(train, 28), 2, cal, "US")
    data, ahead = x.toPandas(), fut.join(fc.actuals(w), ["item_id", "window", "ts"]).toPandas()
    groups = fc._attributes(cols)
    names = list(groups)
    loss = {}
    for bits in itertools.product([0, 1], repeat=len(names)):
        own = [cols[0]] + [cols[i] for b, name in zip(bits, names) if b for i in groups[name]]
        per = []
        for win in (1, 2):
            num, den = {q: 0.0 for q in fc.QUANTILES}, 0.0
            for item in ("a", "b"):
                d = data[(data["item_id"] == item) & (data["window"] == win)]
                a = ahead[(ahead["item_id"] == item) & (ahead["window"] == win)]
                beta, *_ = np.linalg.lstsq(d[own].to_numpy(float), d["target_value"].to_numpy(float), rcond=None)
                s2 = ((d["target_value"] - d[own].to_numpy(float) @ beta) ** 2).sum() / (len(d) - len(own))
                for q in fc.QUANTILES:
                    f = a[own].to_numpy(float) @ beta + fc.Z[q] * math.sqrt(s2)
                    num[q] += float((q * np.maximum(a["y"] - f, 0) + (1 - q) * np.maximum(f - a["y"], 0)).sum())
                den += float(a["y"].abs().sum())
            per.append(sum(2 * num[q] / den for q in fc.QUANTILES) / 3)
        loss[sum(b << i for i, b in enumerate(bits))] = sum(per) / 2
    for i, name in enumerate(names):
        by_orders = []
        for order in itertools.permutations(range(len(names))):
            before = sum(1 << j for j in order[:order.index(i)])
            by_orders.append(loss[before] - loss[before | 1 << i])
        assert math.isclose(rows[name].delta, sum(by_orders) / len(by_orders), rel_tol=1e-3, abs_tol=1e-5)
    assert math.isclose(sum(r.delta for r in rows.values()), loss[0] - loss[15], rel_tol=1e-3, abs_tol=1e-5)
