"""Registered queries against DuckDB. STRATA_ALL=1 runs every query instead of the short list."""

import os

import oracle
import pytest

from strataflow.catalog import QUERIES, SQL, load_all

load_all()
SHORT = """a02_multi_distinct a11_percentiles a15_rollup b01_customer_profile b05_risk_factors_parsed b08_daily_financial_metrics
b17_rfm_segmentation b21_transaction_velocity b23_anomaly_scores d11_percentiles_by_category f03_parse_risk_factors
g06_row_policy_country g07_tag_masking j13_lateral_table_function k02_snapshot_diff k08_incremental_equals_full
k11_stream_velocity k13_event_chain m04_top_customers_by_balance n02_extractive_summary n07_redaction n14_similar_pairs
n17_search q01_check_registry s05_continuous_ingestion s14_insert_only_merge u03_pivot_channel_month w03_running_balance
w04_moving_averages w05_velocity_1h w06_global_ntile x09_date_diff_units y02_stratified_split y10_roc_points""".split()
NAMES = sorted(SQL) if os.environ.get("STRATA_ALL") else SHORT


@pytest.fixture(scope="module")
def con():
    return oracle.connect(oracle.default_dir())


@pytest.mark.parametrize("name", NAMES)
def test_matches_sql(spark, con, name):
    assert oracle.compare(name, QUERIES[name](spark, oracle.default_dir()), con, SQL[name]) is None


def test_every_query_has_sql():
    assert not set(QUERIES) - set(SQL)


def test_entry_runs(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
