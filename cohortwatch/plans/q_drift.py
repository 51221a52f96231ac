"""Queries: drift statistics, test selection, per-column detail and verdicts."""

from __future__ import annotations

from pyspark.sql import functions as F

from cohortwatch.operators import drift as D
from cohortwatch.plans.drift_sql import drift_ctes, verdict_sql
from cohortwatch.plans.fixtures import fixture
from cohortwatch.plans.registry import register, with_ctes

# lineitem split in time: reference period (shipped before mid-1998) vs current period;
# together the two samples are the whole table, and the reference is large (>1000 rows)
PERIOD_SPLIT = "1998-06-01"
# l_gone has values in the reference period only: the verdict must report it
GONE = f"CASE WHEN l_shipdate < TIMESTAMP '{PERIOD_SPLIT} 00:00:00' THEN l_quantity END AS l_gone"
REF_HALF = f"SELECT *, {GONE} FROM lineitem WHERE l_shipdate < TIMESTAMP '{PERIOD_SPLIT} 00:00:00'"
CUR_HALF = f"SELECT *, {GONE} FROM lineitem WHERE l_shipdate >= TIMESTAMP '{PERIOD_SPLIT} 00:00:00'"
HALF_NUM = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber", "l_gone"]
HALF_CAT = ["l_returnflag", "l_linestatus"]

# suppliers (small reference, <= 1000 rows up to sf0.1) vs customers
REF_SMALL = """SELECT s_acctbal AS acctbal, CAST(s_nationkey AS STRING) AS nation,
  CASE WHEN s_acctbal > 5000 THEN 'Y' ELSE 'N' END AS rich FROM supplier"""
CUR_SMALL = """SELECT c_acctbal AS acctbal, CAST(c_nationkey AS STRING) AS nation,
  CASE WHEN c_acctbal > 5000 THEN 'Y' ELSE 'N' END AS rich FROM customer"""
SMALL_NUM = ["acctbal"]
SMALL_CAT = ["nation", "rich"]


def r6(c):
    return F.round(c, 6)


def _halves(spark, sf_dir):
    ref = fixture(spark, sf_dir, REF_HALF, ["lineitem"])
    cur = fixture(spark, sf_dir, CUR_HALF, ["lineitem"])
    return D.drift_table(ref, cur, HALF_NUM, HALF_CAT)


def _small(spark, sf_dir):
    ref = fixture(spark, sf_dir, REF_SMALL, ["supplier"])
    cur = fixture(spark, sf_dir, CUR_SMALL, ["customer"])
    return D.drift_table(ref, cur, SMALL_NUM, SMALL_CAT)


HALF_CTES = dict(ref=REF_HALF, cur=CUR_HALF, **drift_ctes("ref", "cur", HALF_NUM, HALF_CAT))
SMALL_CTES = dict(ref=REF_SMALL, cur=CUR_SMALL, **drift_ctes("ref", "cur", SMALL_NUM, SMALL_CAT))


@register("ks_stat", with_ctes(
    "SELECT column_name, n_ref, n_cur, round(ks_d, 6) AS ks_d, round(ks_p, 6) AS p_value "
    "FROM dt WHERE column_name = 'acctbal'", **SMALL_CTES))
def q_ks_stat(spark, sf_dir):
    t = _small(spark, sf_dir).filter(F.col("column") == "acctbal")
    return t.select(F.col("column").alias("column_name"), "n_ref", "n_cur", r6("ks_d").alias("ks_d"),
                    r6("ks_p").alias("p_value"))


@register("chi2_stat", with_ctes(
    "SELECT column_name, round(chi2, 6) AS chi2, chi2_df, round(chi2_p, 6) AS p_value "
    "FROM dt WHERE column_name = 'nation'", **SMALL_CTES))
def q_chi2_stat(spark, sf_dir):
    t = _small(spark, sf_dir).filter(F.col("column") == "nation")
    return t.select(F.col("column").alias("column_name"), r6("chi2").alias("chi2"), "chi2_df",
                    r6("chi2_p").alias("p_value"))


@register("z_stat", with_ctes(
    "SELECT column_name, round(z, 6) AS z, round(z_p, 6) AS p_value FROM dt WHERE column_name = 'rich'",
    **SMALL_CTES))
def q_z_stat(spark, sf_dir):
    t = _small(spark, sf_dir).filter(F.col("column") == "rich")
    return t.select(F.col("column").alias("column_name"), r6("z").alias("z"), r6("z_p").alias("p_value"))


@register("wasserstein_norm", with_ctes(
    "SELECT column_name, n_values, round(w1_norm, 6) AS w1_norm, round(ks_d, 6) AS ks_d FROM dt WHERE kind = 'num'",
    **HALF_CTES))
def q_wasserstein_norm(spark, sf_dir):
    t = _halves(spark, sf_dir).filter(F.col("kind") == "num")
    return t.select(F.col("column").alias("column_name"), "n_values", r6("w1_norm").alias("w1_norm"),
                    r6("ks_d").alias("ks_d"))


@register("js_distance", with_ctes(
    "SELECT column_name, n_values, round(js, 6) AS js FROM dt", **HALF_CTES))
def q_js_distance(spark, sf_dir):
    t = _halves(spark, sf_dir)
    return t.select(F.col("column").alias("column_name"), "n_values", r6("js").alias("js"))


@register("test_select", with_ctes(
    "SELECT 'halves' AS fixture, column_name, kind, n_ref, n_values, test FROM h "
    "UNION ALL SELECT 'small', column_name, kind, n_ref, n_values, test FROM s",
    h=with_ctes("SELECT * FROM dt", **HALF_CTES), s=with_ctes("SELECT * FROM dt", **SMALL_CTES)))
def q_test_select(spark, sf_dir):
    """The test each column gets from its kind, reference size and distinct count."""
    h = _halves(spark, sf_dir).select(F.lit("halves").alias("fixture"), "*")
    s = _small(spark, sf_dir).select(F.lit("small").alias("fixture"), "*")
    return h.unionByName(s).select("fixture", F.col("column").alias("column_name"), "kind", "n_ref", "n_values", "test")


@register("drift_columns", with_ctes(
    "SELECT column_name, test, round(score, 6) AS score, drifted FROM dt "
    "UNION ALL SELECT column_name, test, round(score, 6), drifted FROM sdt",
    **HALF_CTES, sdt=with_ctes("SELECT * FROM dt", **SMALL_CTES)))
def q_drift_columns(spark, sf_dir):
    """Per-column detail (test, score to 6 decimals, drifted) for both regimes."""
    t = _halves(spark, sf_dir).unionByName(_small(spark, sf_dir))
    return t.select(F.col("column").alias("column_name"), "test", r6("score").alias("score"), "drifted")


@register("drift_verdict", with_ctes(
    "SELECT 'halves' AS fixture, n_columns, n_drifted, round(drift_share, 6) AS drift_share, dataset_drift, "
    "drifted_columns FROM hv UNION ALL SELECT 'small', n_columns, n_drifted, round(drift_share, 6), dataset_drift, "
    "drifted_columns FROM sv",
    hv=with_ctes(verdict_sql(), **HALF_CTES), sv=with_ctes(verdict_sql(), **SMALL_CTES)))
def q_drift_verdict(spark, sf_dir):
    """Dataset verdict without a report."""
    out = None
    for name, t in (("halves", _halves(spark, sf_dir)), ("small", _small(spark, sf_dir))):
        v = D.dataset_verdict(t).select(F.lit(name).alias("fixture"), "n_columns", "n_drifted", r6("drift_share").alias("drift_share"),
                     "dataset_drift", "drifted_columns")
        out = v if out is None else out.unionByName(v)
    return out
