"""Results that must hold beyond the small tables: exact ranks with a hot group and carried
columns, with and without exchange reuse, and the edges of solvers, rules and calendars."""

import datetime as dt

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from flowlab.operators import forecast as fc
from flowlab.operators import fraud as fr
from flowlab.operators import recsys as rs
from flowlab.operators.joins import attach_holidays
from flowlab.operators.ranking import cumulative_within_group, rank_within_group
from flowlab.operators.sampling import stratified_exact_sample
from flowlab.sources import readers as rd

N = 1_000_000


@pytest.mark.parametrize("reuse", ["true", "false"])
def test_ranks_of_a_million_rows_equal_a_plain_window(spark, reuse):
    spark.conf.set("spark.sql.exchange.reuse", reuse)
    try:
        df = spark.range(N).select(F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 1000).alias("g"),
                                   F.xxhash64("id").alias("o"), (F.col("id") % 7).alias("v"), F.concat(F.lit("x"), F.col("id")).alias("carried"))
        got = rank_within_group(df, "g", ["o"])
        w = Window.partitionBy("g").orderBy("o")
        want = df.select("carried", F.row_number().over(w).alias("r"), F.count("*").over(Window.partitionBy("g")).alias("n"))
        bad = got.join(want, "carried", "full").where("__rank is null or r is null or __rank <> r or __size <> n")
        assert got.count() == N and bad.count() == 0
        run = cumulative_within_group(df, ["g"], ["o"], "v")
        total = df.select("carried", F.sum("v").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("c"))
        assert run.join(total, "carried").where("__cum = c").count() == N
    finally:
        spark.conf.unset("spark.sql.exchange.reuse")


def test_split_keeps_every_event_with_its_context(spark):
    ev = spark.range(300_000).select((F.col("id") % 50).alias("USER_ID"), F.col("id").alias("ITEM_ID"), F.xxhash64("id").alias("TIMESTAMP"),
                                     (F.col("id") % 5).alias("context"))
    s = rs.evaluate_split(ev, test_fraction=0.5)
    parts = s["train"].unionByName(s["test_input"]).unionByName(s["test_truth"])
    assert parts.count() == 300_000 and parts.select("ITEM_ID").distinct().count() == 300_000
    seg = rs.segmentation_split(ev)
    assert seg["train"].groupBy("USER_ID").count().where("count <> 4800").count() == 0 and seg["truth"].count() == 60_000


def test_rules_and_verdicts_without_a_match(spark):
    df = spark.createDataFrame([(700.0,), (900.0,), (None,), (1000.0,)], "amt double")
    s = fr.apply_rules(df, fr.AMOUNT_RULES)
    got = [r.o for r in s.select(F.get("outcomes", F.lit(0)).alias("o")).collect()]
    assert got[:3] == [None, None, None] and got[3] is not None


def test_review_without_answers(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"humanLoopName": "l", "humanAnswers": [], "inputContent": {"score": {"fraud_model_insightscore": 1.0}, "taskObject": {"variables": {"trans_num": "t"}}}}')
    r = fr.ingest_verdicts(spark, str(tmp_path)).first()
    assert r.verdict is None and r.trans_num == "t"


def _series(spark, rows):
    return spark.createDataFrame([(i, d, float(v)) for i, d, v in rows], "item_id string, ts date, target_value double")


def test_constant_and_negative_series(spark):
    days = [dt.date(2020, 1, 1) + dt.timedelta(days=k) for k in range(400)]
    s = _series(spark, [("c", d, 1234567) for d in days] + [("n", d, -6 + (k % 3) * 0.1) for k, d in enumerate(days)])
    w = fc.backtest_windows(s, 7, 1)
    ar = fc.forecast_ar_p(w, 7, p=2).where("item_id = 'c' and quantile = 0.5").collect()
    assert len(ar) == 7 and all(abs(r.value - 1234567) < 1 for r in ar)
    assert fc.forecast_harmonic(w, 7).where("value is null or isnan(value)").count() == 0
    ets = {(r.step, r["quantile"]): r.value for r in fc.forecast_ets(w, 7).where("item_id = 'n'").collect()}
    assert all(ets[h, 0.1] <= ets[h, 0.5] <= ets[h, 0.9] < 0 for h in range(1, 8))
    assert fc.forecast_ets(w, 7, nonnegative=True).where("value < 0").count() == 0


def test_backtest_bounds(spark):
    s = _series(spark, [("a", dt.date(2020, 1, 1) + dt.timedelta(days=k), k) for k in range(20)])
    for bad in ((3, 0), (3, 6), (11, 1)):
        with pytest.raises(ValueError):
            fc.backtest_windows(s, bad[0], bad[1])
    assert fc.backtest_windows(s, 5, 2).where("split = 'test' and window = 1").count() == 5


def test_holidays_far_from_today(spark):
    s = _series(spark, [("a", dt.date(1901, 12, 25), 1), ("a", dt.date(2099, 12, 25), 1)])
    cal = fc.holiday_calendar(spark, ("US",), *fc.series_years(s))
    assert attach_holidays(s, cal, "US", "ts", "holiday").where("holiday is null").count() == 0


def test_stratified_sample_counts(spark):
    df = spark.range(1000).select("id", F.when(F.col("id") < 10, "a").otherwise("b").alias("l"))
    got = dict(stratified_exact_sample(df, "l", {"a": 25, "b": 5}, id_col="id").groupBy("l").count().collect())
    assert got == {"a": 10, "b": 5}


def test_explore_gives_new_items_a_slot(spark):
    inter = spark.createDataFrame([(1, 10, 0), (2, 10, 0), (2, 11, 86400 * 100), (3, 12, 86400 * 100)], "USER_ID long, ITEM_ID long, TIMESTAMP long")
    cands = spark.createDataFrame([(1, 10, 0.9), (2, 11, 0.5)], "USER_ID long, ITEM_ID long, score double")
    got = {(r.USER_ID, r.rank): (r.ITEM_ID, round(r.score, 6)) for r in rs.explore(cands, inter, 0.3, 30, 2).collect()}
    assert got == {(1, 1): (10, 0.63), (1, 2): (11, 0.3), (2, 1): (11, 0.65), (2, 2): (12, 0.3)}


def test_newest_file_wins(spark, tmp_path):
    import os
    for i, name in enumerate(("run2", "run1")):
        (tmp_path / name).mkdir()
        f = tmp_path / name / "out.csv"
        f.write_text(f"x\n{i}\n")
        os.utime(f, (1_600_000_000 + i, 1_600_000_000 + i))
    got = rd.latest_output(spark, str(tmp_path), "csv", "x int", header="true", recursiveFileLookup="true")
    assert [r.x for r in got.collect()] == [1]
