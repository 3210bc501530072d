"""Registered queries against DuckDB on the smallest tables.

The heavier ones are compared by ``tools/check_oracle.py`` at sf0.01.
"""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
duckdb = pytest.importorskip("duckdb")

import __spark_entry__ as entry
from slotwise.catalog.views import TABLES
from tools.check_oracle import compare

SF = "/root/testdata/sf0.001"
CHECKED = [
    "scalar_safe_casts", "scalar_time_features", "haversine_route", "trailing_route_stats", "congestion_arr_at_dep",
    "notam_interval_join", "flatten_json", "dedup_keep_last", "upsert_partial", "extract_plan", "rare_groups",
    "distance_bins", "crosstab_margins", "cardinality", "ks_drift", "tvd_shift", "chrono_split", "ts_cv_folds",
    "threshold_sweep", "classifier_metrics", "top_factors", "search_contains", "stream_notices", "gold_rebuild_window",
    "corr_target", "airport_snapshots", "snapshot_columns", "keys_required", "keyset_page", "table_replaced", "training_sources",
    "numbered_rows", "search_indexed", "history_sums", "sketched_quantiles", "row_lookup",
    "report_file", "committed_runs", "ks_by_route", "target_words", "derived_defaults", "leakage_guard", "late_rows", "scored_answers",
    "fitted_fills", "leaderboard", "regressor_leaderboard", "margin_scores", "min_max_scores", "confusion", "roc_auc", "avg_precision",
]
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="driver tables are not here")


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{SF}/{name}.parquet')")
    return connection


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert len(entry.queries()) >= 90


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() == 1000 and "route_avg_delay_7d" in df.columns


@pytest.mark.parametrize("name", CHECKED)
def test_query_matches_oracle(spark, con, name):
    df = entry.queries()[name](spark, SF)
    cursor = con.execute(entry.oracle_sql()[name])
    columns = [c[0] for c in cursor.description]
    assert compare(df.columns, [tuple(r) for r in df.collect()], columns, cursor.fetchall()) is None
