"""Forecasts by hours, days, weeks and months: dates, seasons, ages and lags count periods."""

import datetime as dt
import math

import pytest

from flowlab.operators import forecast as fc


def moments(freq, n):
    if freq == "hour":
        return [dt.datetime(2020, 2, 27, 5) + dt.timedelta(hours=i) for i in range(n)]
    if freq == "month":
        return [dt.date(2015 + i // 12, i % 12 + 1, 1) for i in range(n)]
    return [dt.date(2019, 12, 30) + dt.timedelta(days=i * (7 if freq == "week" else 1)) for i in range(n)]


def windows(spark, freq, values, horizon, n=1):
    kind = "timestamp" if freq == "hour" else "date"
    rows = [(item, t, float(v)) for item, vs in values.items() for t, v in zip(moments(freq, len(vs)), vs)]
    df = spark.createDataFrame(rows, f"item_id string, ts {kind}, target_value double")
    return fc.backtest_windows(fc.fill_gaps(df, freq=freq), horizon, n, freq=freq)


FREQS = ["hour", "day", "week", "month"]


@pytest.mark.parametrize("freq", FREQS)
def test_seasons_repeat_and_dates_meet_the_actuals(spark, freq):
    m, h = fc.SEASONS[freq], fc.SEASONS[freq] + 3
    w = windows(spark, freq, {"a": [100 + 7 * (i % m) for i in range(4 * m + 6)]}, h)
    for name in ("SeasonalNaive", "HoltWinters", "NPTS", "ETS", "Holt", "AR", "ARp", "Harmonic"):
        f = fc.MODELS[name](w, h, freq=freq)
        j = f.join(fc.actuals(w), ["item_id", "window", "ts"]).collect()
        assert len(j) == 3 * h and all(r.value is not None for r in j)
        if name == "SeasonalNaive":
            assert all(r.value == r.y for r in j)                    # a period's value is that of one season before
    scale = fc.mase_scale(w, m, freq).first()["scale"]
    assert scale == 0.0
    out = fc.evaluate(fc.forecast_seasonal_naive(w, h, freq=freq), w, freq=freq).first()
    assert out.RMSE == 0.0 and out.avg_wQL == 0.0


@pytest.mark.parametrize("freq", FREQS)
def test_smoothing_equals_the_recursion(spark, freq):
    y = [10 + 3 * math.sin(i) + 0.2 * i for i in range(40)]
    w = windows(spark, freq, {"a": y}, 4)
    train = y[:-4]
    level = train[0]
    for v in train[1:]:
        level = 0.3 * v + 0.7 * level
    ets = {(r.step, r.quantile): r.value for r in fc.forecast_ets(w, 4, alpha=0.3, freq=freq).collect()}
    assert math.isclose(ets[1, 0.5], level, rel_tol=1e-9)
    lv, b = train[0], 0.0
    for v in train[1:]:
        last, lv = lv, 0.3 * v + 0.7 * (lv + b)
        b = 0.1 * (lv - last) + 0.9 * b
    holt = {(r.step, r.quantile): r.value for r in fc.forecast_holt(w, 4, 0.3, 0.1, freq=freq).collect()}
    assert math.isclose(holt[3, 0.5], lv + 3 * b, rel_tol=1e-9)


@pytest.mark.parametrize("freq", FREQS)
def test_gaps_and_final_forecast(spark, freq):
    t = moments(freq, 9)
    kind = "timestamp" if freq == "hour" else "date"
    df = spark.createDataFrame([("a", t[0], 1.0), ("a", t[3], 4.0), ("b", t[8], 2.0)], f"item_id string, ts {kind}, target_value double")
    got = fc.fill_gaps(df, freq=freq, middlefill="ffill", backfill="ffill").where("item_id = 'a'").orderBy("ts").collect()
    assert [r.ts for r in got] == t and [r.target_value for r in got] == [1.0] * 3 + [4.0] * 6
    long = fc.create_forecast(fc.fill_gaps(df, freq=freq), 2, "ETS", freq=freq).where("item_id = 'a' and quantile = 0.5").orderBy("step").collect()
    assert [r.ts for r in long] == moments(freq, 11)[9:]


def test_a_model_for_each_item(spark):
    """One item repeats by weeks, the other is a line: each gets the model that suits it."""
    season = [5.0, 50.0, 7.0, 90.0, 2.0, 61.0, 30.0] * 12
    w = windows(spark, "day", {"season": season, "line": [3.0 * i + 10 for i in range(84)], "none": [0.0] * 84}, 7, 2)
    f = fc.forecast_seasonal_naive(w, 7).unionByName(fc.forecast_holt(w, 7, 0.8, 0.8))
    chosen = fc.auto_select_items(fc.evaluate(f, w, by=("item_id",)))
    got = {r.item_id: (r.algorithm, r.candidates) for r in chosen.collect()}
    assert got["season"] == ("SeasonalNaive", 2) and got["line"] == ("Holt", 2) and got["none"] == ("Holt", 0)
    best = fc.best_per_item(f, chosen).groupBy("item_id", "algorithm").count().collect()
    assert sorted((r.item_id, r.algorithm, r["count"]) for r in best) == [("line", "Holt", 42), ("none", "Holt", 42), ("season", "SeasonalNaive", 42)]
