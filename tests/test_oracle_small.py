"""Each listed key against its DuckDB oracle on sf0.001 (the full list runs in scripts/check_oracle.py)."""

import datetime as dt
import decimal
import math

import duckdb
import pytest

import __spark_entry__ as E
from cohortwatch.plans.fixtures import TABLES

KEYS = ["clean_pipeline", "feature_pipeline", "code_groups", "first_per_key", "rolling_rows", "describe",
        "quality_profile", "histogram", "asof_ttl", "stratified_split", "sample_replace", "class_report",
        "roc_auc", "fold_means", "ks_stat", "chi2_stat", "wasserstein_norm", "drift_verdict",
        "scenario_summary", "transform_apply", "counter_rate", "alert_rules", "hist_quantile",
        "rolling_drift_replay", "json_records", "placeholder_null", "rare_bucket", "value_shares",
        "missing_profile", "corr_matrix", "target_balance", "latest_lookup", "json_map_columns", "hash_sample",
        "blend", "confusion", "max_abs_diff", "metric_parity", "z_stat", "js_distance", "test_select",
        "corrupt_all", "mode_mean_fit", "unseen_categories", "coerce_numeric", "throughput", "latest_gauge",
        "composite_health", "required_series", "drift_state", "csv_roundtrip", "schema_listing"]


def _norm(v):
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, float) and math.isnan(v):
        return "NaN"
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None)
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda r: tuple((x is None, str(x)) for x in r))


@pytest.fixture(scope="module")
def con(small_dir):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{small_dir}/{t}.parquet')")
    return c


@pytest.mark.parametrize("key", KEYS)
def test_matches_oracle(spark, small_dir, con, key):
    df = E.queries()[key](spark, small_dir)
    cur = con.execute(E.oracle_sql()[key])
    ocols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(ocols)
    assert _rows(df.columns, df.collect()) == _rows(ocols, cur.fetchall())


def test_every_oracle_has_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() >= 0 and "rate" in df.columns
