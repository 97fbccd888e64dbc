"""Top-level double columns per registered query (generated by tools/gen_rounding.py).

Both the Spark result and the oracle keep ``SIGNIFICANT`` digits of these, so that last-digit
differences between engines (summation order, libm) do not change the compared values, while
shares that shrink with the data keep theirs. Values below ``TINY`` count as zero."""

SIGNIFICANT = 9
TINY = 1e-12

ROUND_COLS = {
    'agg2_resample_daily': ['target_value'],
    'agg2_resample_hourly': ['target_value'],
    'agg2_resample_monthly': ['target_value'],
    'agg2_resample_weekly': ['target_value'],
    'flt2_year_range': ['target_value'],
    'flt2_year_range_inclusive': ['target_value'],
    'flt4_score_band': ['fraud_model_insightscore'],
    'flt6_query_forecast': ['p10', 'p50', 'p90'],
    'flt7_min_confidence': ['confidence'],
    'flt7_min_confidence_null_label': ['confidence'],
    'frd11_confusion_at': ['threshold', 'TPR', 'FPR', 'precision', 'alerts_per_100k'],
    'frd12_auc': ['auc'],
    'frd12_roc_curve': ['threshold', 'TPR', 'FPR'],
    'frd13_variable_importance': ['auc', 'importance'],
    'frd14_compare_versions': ['auc'],
    'frd1_prepare_test_sample': ['amt'],
    'frd1_prepare_train': ['amt'],
    'frd3_train_and_score': ['fraud_model_insightscore'],
    'frd4_insight_score': ['amt', 'fraud_model_insightscore'],
    'frd5_rules_all_matched': ['amt'],
    'frd5_rules_first_matched': ['fraud_model_insightscore'],
    'frd7_review_queue': ['fraud_model_insightscore'],
    'frd9_ingest_verdicts': ['fraud_model_insightscore'],
    'frd_flagship_outcomes': ['amount'],
    'img3_evaluate_labels': ['precision', 'recall', 'f1'],
    'img4_error_listing': ['confidence'],
    'joi1_join_items_interactions': ['rating'],
    'joi4_restrict_to_requests': ['score'],
    'joi5_attach_holidays': ['target_value'],
    'joi6_attach_review': ['fraud_model_insightscore'],
    'joi6_pending_review': ['fraud_model_insightscore'],
    'prj10_parse_event_payload': ['amt', 'cc_num', 'city_pop'],
    'prj11_derive_year': ['y'],
    'prj12_boxes_to_pixels': ['confidence', 'left_px', 'top_px', 'right_px', 'bottom_px'],
    'prj1_apply_mapping': ['amt', 'lat', 'long', 'merch_lat', 'merch_long'],
    'prj2_drop_fields': ['amt'],
    'prj3_rename_field': ['amount'],
    'prj5_add_constant': ['target_value'],
    'prj8_split_fields': ['rating'],
    'prj9_conform_variables': ['city_pop', 'amt', 'cc_num'],
    'rec10_popularity_count': ['score'],
    'rec10_recommend_popular': ['score'],
    'rec12_coverage': ['coverage'],
    'rec13_15_ranking_metrics': ['mrr_at_25', 'ndcg_at_5', 'precision_at_5', 'ndcg_at_10', 'precision_at_10', 'ndcg_at_25', 'precision_at_25'],
    'rec2_rec4_als_recommend': ['score'],
    'rec3_tune': ['ndcg'],
    'rec5_normalise_by_context': ['score'],
    'rec5_normalise_scores': ['score'],
    'rec5_normalise_als': ['score'],
    'rec6_als_segment_users': ['score'],
    'rec7_explore': ['score'],
    'rec9_similar_items': ['score'],
    'rec9_similar_items_heavy': ['score'],
    'rec8_recommend_with_context': ['score'],
    'rec8_rerank_in_context': ['score'],
    'rec_als_metrics': ['mrr_at_25', 'ndcg_at_5', 'precision_at_5', 'ndcg_at_10', 'precision_at_10', 'ndcg_at_25', 'precision_at_25'],
    'smp1_latest_events': ['value'],
    'smp3_bernoulli_sample_hash': ['rating'],
    'smp3_bernoulli_sample_random': ['rating'],
    'snk1_single_csv_of_test_sample': ['amt'],
    'snk2_parquet_round_trip': ['amt', 'lat'],
    'snk3_json_round_trip': ['amt', 'lat'],
    'sql1_sql_query': ['total'],
    'src11_latest_output': ['amt', 'lat'],
    'src1_snk1_single_csv_round_trip': ['amt', 'lat'],
    'src2_read_table': ['amt', 'lat'],
    'src3_register_csv_table': ['amt', 'lat'],
    'src4_read_csv_inferred': ['amt', 'lat'],
    'src5_read_csv_matching': ['amt', 'lat'],
    'str1_arrivals': ['value'],
    'str2_route_by_file': ['score'],
    'str4_score_events': ['amt', 'fraud_model_insightscore'],
    'str5_review_sink': ['amt', 'fraud_model_insightscore'],
    'str6_one_pipeline_batch': ['amt', 'fraud_model_insightscore'],
    'str7_dedup_deliveries': ['value'],
    'str8_resample_stream': ['value'],
    'str9_enrich_stream': ['value'],
    'ts10_ts11_evaluate': ['RMSE', 'MAPE', 'WAPE', 'wQL_p10', 'wQL_p50', 'wQL_p90', 'avg_wQL', 'MASE'],
    'ts10_ts11_evaluate_weekly': ['RMSE', 'MAPE', 'WAPE', 'wQL_p10', 'wQL_p50', 'wQL_p90', 'avg_wQL', 'MASE'],
    'ts10_ts11_evaluate_monthly': ['RMSE', 'MAPE', 'WAPE', 'wQL_p10', 'wQL_p50', 'wQL_p90', 'avg_wQL', 'MASE'],
    'ts12_summarise_windows': ['RMSE', 'MAPE', 'WAPE', 'MASE', 'wQL_p10', 'wQL_p50', 'wQL_p90', 'avg_wQL'],
    'ts13_auto_select_items': ['avg_wQL'],
    'ts13_auto_select': ['avg_wQL'],
    'ts14_metrics_table': ['AR', 'ETS', 'Holt', 'HoltWinters', 'NPTS', 'SeasonalNaive'],
    'ts15_create_forecast': ['quantile', 'value'],
    'ts16_forecast_long': ['value'],
    'ts16_forecast_wide': ['p10', 'p50', 'p90'],
    'ts17_explain_impact': ['delta', 'impact'],
    'ts1_prepare_series': ['target_value'],
    'ts2_fill_gaps': ['target_value'],
    'ts2_fill_gaps_median_ffill': ['target_value'],
    'ts3_calendar_features': ['target_value', 'sin_y1', 'cos_y1', 'sin_y2', 'cos_y2', 'sin_w1', 'cos_w1'],
    'ts4_backtest_windows': ['target_value'],
    'ts4_backtest_windows_monthly': ['target_value'],
    'ts4_backtest_windows_weekly': ['target_value'],
    'ts5_seasonal_naive': ['quantile', 'value'],
    'ts5_seasonal_naive_weekly': ['quantile', 'value'],
    'ts5_seasonal_naive_monthly': ['quantile', 'value'],
    'ts6_npts': ['quantile', 'value'],
    'ts6_npts_weekly': ['quantile', 'value'],
    'ts6_npts_monthly': ['quantile', 'value'],
    'ts6_npts_seasonal': ['quantile', 'value'],
    'ts7_ets': ['quantile', 'value'],
    'ts7_ets_weekly': ['quantile', 'value'],
    'ts7_ets_monthly': ['quantile', 'value'],
    'ts7_holt': ['quantile', 'value'],
    'ts7_holt_weekly': ['quantile', 'value'],
    'ts7_holt_monthly': ['quantile', 'value'],
    'ts7_holt_winters': ['quantile', 'value'],
    'ts7_holt_winters_weekly': ['quantile', 'value'],
    'ts7_holt_winters_monthly': ['quantile', 'value'],
    'ts8_ar': ['quantile', 'value'],
    'ts8_ar_weekly': ['quantile', 'value'],
    'ts8_ar_monthly': ['quantile', 'value'],
    'ts9_harmonic': ['quantile', 'value'],
    'txt2_transcript_words': ['start_time', 'end_time', 'confidence', 'pause'],
    'txt4_flatten_entities': ['Score'],
    'txt4_flatten_key_phrases': ['Score'],
    'txt6_learn_lexicon': ['polarity'],
    'txt7_entities': ['Score'],
    'txt8_key_phrases': ['Score'],
}


def significant(column):
    """A Spark column rounded to ``SIGNIFICANT`` digits."""
    from pyspark.sql import functions as F

    text = F.format_string(f"%.{SIGNIFICANT - 1}e", column.cast("double")).cast("double")
    return F.when(F.abs(column) < TINY, F.lit(0.0)).when(column.isNotNull(), text)


def significant_sql(name: str) -> str:
    """The same in the oracle's SQL."""
    return f"CASE WHEN abs(\"{name}\") < {TINY} THEN 0.0 WHEN \"{name}\" IS NOT NULL THEN CAST(format('{{:.{SIGNIFICANT - 1}e}}', CAST(\"{name}\" AS DOUBLE)) AS DOUBLE) END"
