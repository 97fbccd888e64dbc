"""Tier 4: hand-made edge fixtures."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from flowlab.operators import fraud as fr
from flowlab.operators import forecast as fc
from flowlab.operators import recsys as rs
from flowlab.operators import text as tx
from flowlab.operators.filters import time_cutoff_split, year_range
from flowlab.operators.mapping import apply_mapping, drop_fields, parse_event_payload, recode_label
from flowlab.operators.setops import split_statements
from flowlab.sources import readers as rd

RAW_SCHEMA = ("`index` int, trans_date_trans_time string, cc_num long, merchant string, category string, amt double, "
              "`first` string, `last` string, gender string, street string, city string, state string, zip long, lat double, "
              "`long` double, city_pop long, job string, dob string, trans_num string, unix_time long, merch_lat double, "
              "merch_long double, is_fraud long")


@pytest.fixture(scope="module")
def raw(spark, fixtures):
    return rd.read_csv(spark, os.path.join(fixtures, "card_transactions.csv"), RAW_SCHEMA)


def test_csv_quotes_and_commas(raw):
    r = raw.filter("index = 0").first()
    assert r["merchant"] == "fraud_Rippin, Kub and Mann"
    assert r["job"] == "Psychologist, counselling"


def test_mapping_bad_values_become_null(raw):
    m = apply_mapping(raw, fr.CARD_TRANSACTION_MAPPINGS)
    assert "index" not in m.columns                      # unmapped columns do not survive
    r = {x["trans_num"]: x for x in m.collect()}
    assert r["t0004"]["trans_date_trans_time"] is None    # bad timestamp
    assert r["t0003"]["is_fraud"] is None                 # missing label
    assert dict(m.dtypes)["is_fraud"] == "smallint"


def test_mapping_strict_raises(spark, raw):
    with pytest.raises(Exception):
        apply_mapping(raw, fr.CARD_TRANSACTION_MAPPINGS, strict=True).collect()


def test_drop_missing_column_is_noop(raw):
    assert drop_fields(raw, ["col0", "lat"]).columns == [c for c in raw.columns if c != "lat"]


def test_recode_unmatched_label_is_null(raw):
    m = apply_mapping(raw, fr.CARD_TRANSACTION_MAPPINGS)
    r = {x["trans_num"]: x["lbl"] for x in recode_label(m, "is_fraud", fr.LABELS, "lbl").collect()}
    assert r["t0001"] == "legit" and r["t0002"] == "fraud"
    assert r["t0007"] is None and r["t0003"] is None      # label 2 and null


def test_cutoffs_are_strict(raw):
    m = apply_mapping(raw, fr.CARD_TRANSACTION_MAPPINGS)
    tr, te = time_cutoff_split(m, "trans_date_trans_time", "2020-04-30 00:00:00", "2020-08-30 00:00:00")
    trn = {r["trans_num"] for r in tr.collect()}
    ten = {r["trans_num"] for r in te.collect()}
    assert "t0005" not in trn and "t0006" not in ten    # rows on the cutoffs belong to neither
    assert not trn & ten
    with pytest.raises(ValueError):
        time_cutoff_split(m, "trans_date_trans_time", "2021-01-01", "2020-01-01")


def test_prepare_fraud_fewer_frauds_than_asked(raw):
    p = fr.prepare_fraud(raw, "2020-04-30 00:00:00", "2020-08-30 00:00:00", fraud_samples=12, legit_samples=130)
    s = p["test_sample"]
    assert s.columns[-4:] == ["EVENT_TIMESTAMP", "ENTITY_TYPE", "ENTITY_ID", "EVENT_ID"]
    assert "EVENT_LABEL" not in s.columns
    assert s.count() == 3       # t0008 fraud (1 < 12), t0009 and t0010 legit; t0007 label 2 is neither
    assert p["train"].columns[-2:] == ["EVENT_TIMESTAMP", "EVENT_LABEL"]


def test_payload_defaults_and_flow(spark, fixtures):
    df = spark.read.text(os.path.join(fixtures, "payload.json"))
    p = {r["trans_num"]: r for r in parse_event_payload(df, "value", fr.CARD_VARIABLES).collect()}
    assert p["6cee353a9d618adfbb12ecad9d427244"]["city_pop"] == 0.0    # unparsable -> default
    assert p["6cee353a9d618adfbb12ecad9d427244"]["flow_definition"] == "arn-flow"
    assert p["x2"]["flow_definition"] == "ignore" and p["x2"]["city"] == "null"
    assert p["x2"]["EVENT_TIMESTAMP"] == dt.datetime(2020, 10, 14, 1, 0)


def test_rules_gap_free_and_gap(spark):
    df = spark.createDataFrame([(s,) for s in [699.9, 700.0, 700.1, 899.9, 900.0, 900.1, None]],
                               "fraud_model_insightscore double")
    r = {x[0]: x["rule_id"] for x in fr.apply_rules(df, fr.SCORE_RULES).collect()}
    assert r[700.0] == "low_fraud_risk" and r[900.0] == "medium_fraud_risk" and r[900.1] == "high_fraud_risk"
    assert r[None] is None
    a = {x[0]: x["rule_id"] for x in fr.apply_rules(df.withColumnRenamed("fraud_model_insightscore", "amt"),
                                                     fr.AMOUNT_RULES).collect()}
    assert a[700.0] is None and a[900.0] is None and a[700.1] == "review"


def test_review_band_closed(spark):
    df = spark.createDataFrame([(s, "f") for s in [699.9, 700.0, 900.0, 900.1]], "fraud_model_insightscore double, flow_definition string")
    assert sorted(r[0] for r in fr.review_queue(df).collect()) == [700.0, 900.0]


def test_year_range_checks(spark):
    df = spark.createDataFrame([("1999-12-31",), ("2000-01-01",), ("2001-06-01",), ("2002-01-01",)], "ds string")
    assert [r[0] for r in year_range(df, "ds", 1999, 2002).collect()] == ["2000-01-01", "2001-06-01"]
    assert year_range(df, "ds", 1999, 2002, inclusive=True).count() == 4
    with pytest.raises(ValueError):
        year_range(df, "ds", 2002, 1999)


def test_fill_gaps_start_middle_end(spark):
    d = lambda x: dt.date(2020, 1, x)
    s = spark.createDataFrame([("a", d(2), 1.0), ("a", d(4), 2.0), ("b", d(1), 5.0), ("b", d(6), 1.0)],
                              "item_id string, ts date, target_value double")
    f = fc.fill_gaps(s, middlefill="zero", backfill="nan")
    rows = {(r["item_id"], r["ts"].day): (r["target_value"], r["was_filled"]) for r in f.collect()}
    assert rows[("a", 3)] == (0.0, True)             # middle
    assert rows[("a", 5)][0] is None                 # back-filled tail to the common end (nan)
    assert ("a", 1) not in rows                      # no front fill before the first point
    assert len([k for k in rows if k[0] == "b"]) == 6


def test_single_point_and_zero_series(spark):
    s = spark.createDataFrame([("z", dt.date(2020, 1, i), 0.0) for i in range(1, 21)] + [("one", dt.date(2020, 1, 20), 3.0)],
                              "item_id string, ts date, target_value double")
    w = fc.backtest_windows(fc.fill_gaps(s), 5, 1)
    f = fc.forecast_npts(w, 5)
    m = fc.evaluate(f, w).collect()
    assert m and m[0]["WAPE"] is None and m[0]["wQL_p50"] is None   # all-zero truth: no denominator


def test_results_error_and_unknown_item(spark, fixtures):
    res = rd.read_recommendations(spark, os.path.join(fixtures, "results.json.out"))
    assert res.count() == 3                           # blank line skipped
    meta = rd.read_csv(spark, os.path.join(fixtures, "movies.csv"), "movieId long, title string, genres string")
    out = {r["userId"]: r for r in rs.transform_results(res, meta).collect()}
    assert set(out) == {1, 2}                         # the error record is dropped
    assert out[1]["Recommendations"] == ("American President, The (1995) (Comedy) | Story of \"Us\" (1999) (Drama)")
    assert out[1]["unknown_items"] == 1


def test_transcript_fixture(spark, fixtures):
    docs = rd.read_json_docs(spark, os.path.join(fixtures, "transcript.json"), tx.TRANSCRIPT_SCHEMA)
    assert tx.transcript_text(docs).first()["transcript"] == "Machine learning is employed."
    w = {r["pos"]: r for r in tx.transcript_words(docs).collect()}
    assert w[2]["pause"] == pytest.approx(0.3)
    assert w[1]["low_confidence"] is True and w[4]["start_time"] is None


def test_empty_entities(spark):
    docs = spark.createDataFrame([(1, "nothing to see here"), (2, "mail a.b@example.com now")], "doc_id long, text string")
    e = tx.entities(docs).collect()
    assert [(r["doc_id"], r["Type"], r["BeginOffset"], r["EndOffset"]) for r in e] == [(2, "EMAIL", 5, 20)]
    lex = spark.createDataFrame([("x", 0.0)], "word string, polarity double")
    a = tx.flatten_analysis(tx.analyse(docs, lex))
    assert a["entities"].filter("doc_id = 1").count() == 0


def test_split_statements():
    assert split_statements("select ';' as a; -- c;\n select 2 ;;") == ["select ';' as a", "select 2"]
