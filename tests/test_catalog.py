"""Quick registered queries against the same SQL on DuckDB, at the smallest scale."""

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from check import TABLES, canonical

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="test tables are not here")

QUICK = (
    "pure_premium_by_area", "profile_columns", "validate_bronze_freq", "validate_lenient", "flag_duplicates",
    "cap_large_losses_quantile", "join_frequency_severity", "clean_stats", "lineage_check", "grouped_stratified_split",
    "target_columns", "segment_ae", "weighted_bins", "normalized_gini", "lorenz_curves_by_model", "psi_report",
    "psi_from_reference", "price_quotes", "top_reason_codes", "spline_basis", "glm_severity_one_way", "stream_drift",
    "gold_build", "validate_job", "gbm_first_splits", "stream_price", "lineage_manifest",
)


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for t in TABLES:
        connection.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF_DIR}/{t}.parquet'")
    return connection


@pytest.mark.parametrize("name", QUICK)
def test_query_equals_sql(spark, db, name):
    df = entry.queries()[name](spark, SF_DIR)
    result = db.sql(entry.oracle_sql()[name])
    order = sorted(df.columns)
    assert order == sorted(result.columns)
    mine = canonical([tuple(r) for r in df.collect()], df.columns, order)
    assert mine == canonical(result.fetchall(), result.columns, order)


def test_every_sql_belongs_to_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert len(entry.queries()) >= 110


def test_entry_runs(spark):
    assert entry.entry(spark).count() == 6
