"""Registered queries beside their SQL twins; a choice of each group here, all of them by verify.py."""

import duckdb
import pytest

from tidemark.plans import all_queries, all_sql
from verify import TABLES, rows_of

SF = "/root/testdata/sf0.001"
CHOSEN = """f02_receipt_date j03_pit_interval_join j04_pit_latest_eligible j05_asof_backward j08_exact_period_lag j12_asof_history
a01_dedup_prefer a13_gaps_and_islands w06_rolling_regression w11_forward_max_drawdown w12_cross_section_rank w13_cross_section_winsorize
w17_ntile_buckets t01_topk_per_group d04_price_quality d10_filing_activity d14_net_issuance d22_metric_vintages d23_quarterize
l01_forward_labels m13_ridge_walk_forward m16_candidate_gate m06_walk_forward_folds m12_economic_report h04_newey_west h05_p_values h06_benjamini_hochberg h10_permute_cross_section h11_temporal_placebo h13_cohort_inference h14_cluster_bootstrap d08_price_momentum
d14_issuance_strict_pit d22_receipt_pairs d23_reconciled_quarters d24_event_study d12_fin_scan_availability d12_fin_scan_industry_neutral d15_payout_positions x04_feature_catalog x04_check_catalog s12_portable_fingerprint l03_scan_labels h03_scan_combinations h20_exclusion_funnel h17_screen_pass q01_coverage_report
q22_outstanding_windows e05_rank_persistence s08_upsert s20_merge_with_retention st1_stream_upsert""".split()


@pytest.mark.parametrize("name", CHOSEN)
def test_query_equals_sql(spark, name):
    df = all_queries()[name](spark, SF)
    got = rows_of(df.columns, df.collect())
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    r = con.execute(all_sql()[name])
    assert sorted(df.columns) == sorted(d[0] for d in r.description)
    assert got == rows_of([d[0] for d in r.description], r.fetchall())


def test_every_sql_twin_has_a_query():
    assert set(all_sql()) <= set(all_queries())
