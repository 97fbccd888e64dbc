"""Tier 2: identities that the saved outputs of the reference also satisfy."""

import math

from pyspark.sql import functions as F

from flowlab.operators import forecast as fc
from flowlab.plans import q_forecast as qf
from flowlab.plans import q_recsys as qr

from .conftest import SF_SMALL


def test_summary_is_mean_of_windows_and_wql_mean(spark):
    m = qf.metrics(spark, SF_SMALL)
    s = fc.summarise_windows(m)
    rows = s.collect()
    for algo in {r["algorithm"] for r in rows}:
        comp = [r for r in rows if r["algorithm"] == algo and r["EvaluationType"] == "COMPUTED"]
        summ = [r for r in rows if r["algorithm"] == algo and r["EvaluationType"] == "SUMMARY"][0]
        assert math.isclose(summ["RMSE"], sum(r["RMSE"] for r in comp) / len(comp), rel_tol=1e-9)
        for r in comp:
            assert math.isclose(r["avg_wQL"], (r["wQL_p10"] + r["wQL_p50"] + r["wQL_p90"]) / 3, rel_tol=1e-9)
            if algo == "SeasonalNaive":          # point forecast: WAPE == wQL[0.5]
                assert math.isclose(r["WAPE"], r["wQL_p50"], rel_tol=1e-9)


def test_quantiles_ordered(spark):
    w = qf.windows(spark, SF_SMALL)
    for f in (fc.forecast_npts(w, qf.H), fc.forecast_ar(w, qf.H), fc.forecast_ets(w, qf.H)):
        wide = fc.forecast_wide(f)
        assert wide.filter((F.col("p10") > F.col("p50") + 1e-9) | (F.col("p50") > F.col("p90") + 1e-9)).count() == 0


def test_result_records_scores_descending(spark):
    rows = qr.results(spark, SF_SMALL).filter("error IS NULL").collect()
    assert rows
    for r in rows:
        sc = r["output"]["scores"]
        assert len(sc) == 25 and sc == sorted(sc, reverse=True)


def test_holt_closed_form_equals_recursion(spark):
    import datetime as dt

    ys = [3.0, 5.0, 4.0, 6.0, 8.0, 7.0, 9.0, 12.0, 11.0, 13.0]
    a, b = 0.4, 0.2
    lvl, tr = ys[0], 0.0
    for y in ys[1:]:
        new_l = a * y + (1 - a) * (lvl + tr)
        tr = b * (new_l - lvl) + (1 - b) * tr
        lvl = new_l
    s = spark.createDataFrame([("i", dt.date(2020, 1, 1) + dt.timedelta(days=k), y) for k, y in enumerate(ys)],
                              "item_id string, ts date, target_value double")
    w = fc.final_cutoff(s)
    f = fc.forecast_wide(fc.forecast_holt(w, 3, alpha=a, beta=b)).orderBy("step").collect()
    for r in f:
        assert math.isclose(r["p50"], lvl + r["step"] * tr, rel_tol=1e-9)


def test_holt_winters_closed_form_equals_recursion(spark):
    import datetime as dt

    m, a, b, g = 7, 0.3, 0.1, 0.2
    ys = [10 + (k % 7) * 2.0 + 0.3 * k + (1.5 if k % 5 == 0 else 0.0) for k in range(40)]
    lvl, tr, seas = ys[0], 0.0, [0.0] * m          # seas[i] = s_(t-i)
    for y in ys[1:]:
        s_old = seas[m - 1]
        new_l = a * (y - s_old) + (1 - a) * (lvl + tr)
        tr = b * (new_l - lvl) + (1 - b) * tr
        new_s = g * (y - new_l) + (1 - g) * s_old
        lvl, seas = new_l, [new_s] + seas[:-1]
    s = spark.createDataFrame([("i", dt.date(2020, 1, 1) + dt.timedelta(days=k), y) for k, y in enumerate(ys)],
                              "item_id string, ts date, target_value double")
    f = fc.forecast_wide(fc.forecast_holt_winters(fc.final_cutoff(s), 10, a, b, g, m)).orderBy("step").collect()
    for r in f:
        h = r["step"]
        expect = lvl + h * tr + seas[(m - h % m) % m]
        assert math.isclose(r["p50"], expect, rel_tol=1e-9), (h, r["p50"], expect)


def test_ar_p_recovers_coefficients(spark):
    import datetime as dt
    import random

    rnd = random.Random(1)
    ys = [1.0, 2.0]
    for _ in range(400):
        ys.append(2.0 + 0.5 * ys[-1] - 0.3 * ys[-2] + rnd.gauss(0, 0.01))
    s = spark.createDataFrame([("i", dt.date(2020, 1, 1) + dt.timedelta(days=k), y) for k, y in enumerate(ys)],
                              "item_id string, ts date, target_value double")
    f = fc.forecast_wide(fc.forecast_ar_p(fc.final_cutoff(s), 2, p=2)).orderBy("step").collect()
    e1 = 2.0 + 0.5 * ys[-1] - 0.3 * ys[-2]
    assert abs(f[0]["p50"] - e1) < 0.01
    assert f[0]["p10"] < f[0]["p50"] < f[0]["p90"]
