"""Queries: profiling."""

from __future__ import annotations

from pyspark.sql import functions as F

from cohortwatch import schemas as S
from cohortwatch.functions.values import py_round
from cohortwatch.operators import clean as C
from cohortwatch.operators import profile as PR
from cohortwatch.plans.fixtures import (ENCOUNTERS_SQL, LINE_TARGET_SQL, encounters,
                                        line_target, read_table)
from cohortwatch.plans.q_clean import P01_SQL
from cohortwatch.plans.registry import register, with_ctes

NUM = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
LT = dict(lt=LINE_TARGET_SQL)
ENC = dict(enc=ENCOUNTERS_SQL, p01=P01_SQL)
PROFILE_COLS = ["race", "gender", "medical_specialty", "diag_1", "readmitted",
                "discharge_disposition_id", "num_lab_procedures"]


def r6(c):
    return F.round(c, 6)


def _raw_enc(spark, sf_dir):
    return C.placeholder_to_null(encounters(spark, sf_dir), S.PLACEHOLDER)


@register("value_counts", "SELECT p_type, count(*) AS n FROM part WHERE p_type IS NOT NULL GROUP BY p_type")
def q_value_counts(spark, sf_dir):
    return PR.value_counts(read_table(spark, sf_dir, "part"), "p_type")


@register("value_shares", with_ctes(
    "SELECT medical_specialty, count(*) AS n, "
    "round(count(*) * 1.0 / (SELECT count(medical_specialty) FROM p01), 6) AS share "
    "FROM p01 WHERE medical_specialty IS NOT NULL GROUP BY medical_specialty", **ENC))
def q_value_shares(spark, sf_dir):
    out = PR.value_shares(_raw_enc(spark, sf_dir), "medical_specialty")
    return out.select("medical_specialty", "n", r6("share").alias("share"))


def _missing_parts():
    return [f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS n_missing, "
            f"round(count(*) FILTER (WHERE {c} IS NULL) * 100.0 / count(*), 6) AS pct_missing FROM p01"
            for c in PROFILE_COLS]


@register("missing_profile", with_ctes(" UNION ALL ".join(_missing_parts()), **ENC))
def q_missing_profile(spark, sf_dir):
    out = PR.missing_profile(_raw_enc(spark, sf_dir), PROFILE_COLS)
    return out.select(F.col("column").alias("column_name"), "n_missing", r6("pct_missing").alias("pct_missing"))


def _describe_sql():
    parts = [f"""SELECT '{c}' AS column_name, count({c}) AS n, CAST(sum(CAST({c} AS DECIMAL(30, 2))) AS DOUBLE) / count({c}) AS mean,
      round(stddev_samp({c}), 6) AS std, round(min({c}), 6) AS min_value,
      round(quantile_cont({c}, 0.25), 6) AS q25, round(quantile_cont({c}, 0.5), 6) AS q50,
      round(quantile_cont({c}, 0.75), 6) AS q75, round(max({c}), 6) AS max_value FROM lt""" for c in NUM]
    return with_ctes(" UNION ALL ".join(parts), **LT)


@register("describe", _describe_sql())
def q_describe(spark, sf_dir):
    d = PR.describe(line_target(spark, sf_dir), NUM, exact=True, decimal_scale=2)
    return d.select(F.col("column").alias("column_name"), F.col("count").alias("n"),
                    F.col("mean"), r6("std").alias("std"), r6("min").alias("min_value"),
                    r6("q25").alias("q25"), r6("q50").alias("q50"), r6("q75").alias("q75"),
                    r6("max").alias("max_value"))


def _corr_sql(cols, target=None):
    if target:
        parts = [f"SELECT '{c}' AS column_name, round(corr({c}, {target}), 6) AS corr FROM lt" for c in cols]
    else:
        parts = [f"SELECT '{a}' AS col_a, '{b}' AS col_b, round(corr({a}, {b}), 6) AS corr FROM lt"
                 for a in cols for b in cols]
    return with_ctes(" UNION ALL ".join(parts), **LT)


@register("corr_matrix", _corr_sql(NUM))
def q_corr_matrix(spark, sf_dir):
    out = PR.corr_matrix(line_target(spark, sf_dir), NUM)
    return out.select("col_a", "col_b", r6("corr").alias("corr"))


@register("target_corr", _corr_sql(NUM + ["l_linenumber"], "target"))
def q_target_corr(spark, sf_dir):
    out = PR.target_corr(line_target(spark, sf_dir), NUM + ["l_linenumber"], "target")
    return out.select(F.col("column").alias("column_name"), r6("corr").alias("corr"))


@register("rate_by_group", with_ctes(
    "SELECT l_linestatus, count(*) AS n, round(avg(target), 6) AS rate FROM lt GROUP BY l_linestatus", **LT))
def q_rate_by_group(spark, sf_dir):
    out = PR.rate_by_group(line_target(spark, sf_dir), "l_linestatus", "target")
    return out.select("l_linestatus", "n", r6("rate").alias("rate"))


@register("rate_all_groups", with_ctes("""
SELECT g.l_linenumber, COALESCE(r.n, 0) AS n, r.rate
FROM range(0, 11) g(l_linenumber)
LEFT JOIN (SELECT l_linenumber, count(*) AS n, round(avg(target), 6) AS rate FROM lt GROUP BY l_linenumber) r
  ON g.l_linenumber = r.l_linenumber
""", **LT))
def q_rate_all_groups(spark, sf_dir):
    out = PR.rate_all_groups(spark, line_target(spark, sf_dir), "l_linenumber", "target", 0, 10)
    return out.select("l_linenumber", "n", r6("rate").alias("rate"))


@register("rate_predicate", with_ctes(
    "SELECT l_linestatus, count(*) AS n, round(avg(CASE WHEN l_quantity > 25 THEN 1.0 ELSE 0.0 END), 6) AS rate "
    "FROM lt GROUP BY l_linestatus", **LT))
def q_rate_predicate(spark, sf_dir):
    out = PR.rate_predicate(line_target(spark, sf_dir), "l_linestatus", F.col("l_quantity") > 25)
    return out.select("l_linestatus", "n", r6("rate").alias("rate"))


@register("rate_capped", with_ctes(
    "SELECT LEAST(l_linenumber, 5) AS l_linenumber, count(*) AS n, round(avg(target), 6) AS rate "
    "FROM lt GROUP BY LEAST(l_linenumber, 5)", **LT))
def q_rate_capped(spark, sf_dir):
    out = PR.rate_capped(line_target(spark, sf_dir), "l_linenumber", "target", 5)
    return out.select("l_linenumber", "n", r6("rate").alias("rate"))


@register("positive_rate", with_ctes(
    "SELECT count(*) AS n, round(avg(target), 6) AS positive_rate, "
    "round_even(CAST(sum(target) AS DOUBLE) * 100 / count(*), 1) AS pct_half_even FROM lt", **LT))
def q_positive_rate(spark, sf_dir):
    """G11 and F14 (half-to-even rounding of the percentage)."""
    out = PR.positive_rate(line_target(spark, sf_dir), "target")
    return out.select("n", r6("positive_rate").alias("positive_rate"),
                      py_round(F.col("positive_rate") * 100, 1).alias("pct_half_even"))


@register("histogram", """
WITH b AS (SELECT min(value) AS lo, max(value) AS hi FROM events),
h AS (
  SELECT CAST(LEAST(floor((value - lo) / ((hi - lo) / 30.0)), 29) AS BIGINT) AS bin, count(*) AS n
  FROM events, b WHERE value IS NOT NULL GROUP BY 1)
SELECT g.bin, round(lo + g.bin * ((hi - lo) / 30.0), 6) AS bin_low,
  round(lo + (g.bin + 1) * ((hi - lo) / 30.0), 6) AS bin_high, COALESCE(h.n, 0) AS n
FROM range(0, 30) g(bin) CROSS JOIN b LEFT JOIN h ON g.bin = h.bin
""")
def q_histogram(spark, sf_dir):
    out = PR.histogram(spark, read_table(spark, sf_dir, "events"), "value", 30)
    return out.select("bin", r6("bin_low").alias("bin_low"), r6("bin_high").alias("bin_high"), "n")


@register("row_count", "SELECT 'lineitem' AS table_name, count(*) AS n FROM lineitem "
                       "UNION ALL SELECT 'orders', count(*) FROM orders")
def q_row_count(spark, sf_dir):
    li = read_table(spark, sf_dir, "lineitem").agg(F.count(F.lit(1)).alias("n"))
    od = read_table(spark, sf_dir, "orders").agg(F.count(F.lit(1)).alias("n"))
    return (li.select(F.lit("lineitem").alias("table_name"), "n")
              .unionByName(od.select(F.lit("orders").alias("table_name"), "n")))


@register("distinct_counts", with_ctes(" UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(DISTINCT {c}) AS n_distinct FROM lt"
    for c in ["l_returnflag", "l_linestatus", "l_discount", "l_tax", "l_quantity", "l_partkey"]), **LT))
def q_distinct_counts(spark, sf_dir):
    out = PR.distinct_counts(line_target(spark, sf_dir),
                             ["l_returnflag", "l_linestatus", "l_discount", "l_tax", "l_quantity", "l_partkey"])
    return out.select(F.col("column").alias("column_name"), "n_distinct")


@register("target_balance", with_ctes(
    "SELECT target AS class, count(*) AS n, round(count(*) * 100.0 / (SELECT count(*) FROM lt), 6) AS pct "
    "FROM lt GROUP BY target", **LT))
def q_target_balance(spark, sf_dir):
    out = PR.target_balance(line_target(spark, sf_dir), "target")
    return out.select("class", "n", r6("pct").alias("pct"))


@register("cumulative_share", with_ctes("""
SELECT medical_specialty, n, round(share, 6) AS share,
  round(sum(share) OVER (ORDER BY n DESC, medical_specialty ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 6)
    AS cum_share
FROM (SELECT medical_specialty, count(*) AS n, count(*) * 1.0 / (SELECT count(medical_specialty) FROM p01) AS share
      FROM p01 WHERE medical_specialty IS NOT NULL GROUP BY medical_specialty)
""", **ENC))
def q_cumulative_share(spark, sf_dir):
    out = PR.cumulative_share(_raw_enc(spark, sf_dir), "medical_specialty")
    return out.select("medical_specialty", "n", r6("share").alias("share"), r6("cum_share").alias("cum_share"))


@register("top_k_groups", """
SELECT p_brand, count(*) AS n FROM part WHERE p_brand IS NOT NULL
GROUP BY p_brand ORDER BY n DESC, p_brand LIMIT 10
""")
def q_top_k_groups(spark, sf_dir):
    return PR.top_k_groups(read_table(spark, sf_dir, "part"), "p_brand", 10)


QUALITY_NUM = ["discharge_disposition_id", "num_lab_procedures", "num_medications", "number_outpatient"]
QUALITY_COLS = PROFILE_COLS + [c for c in QUALITY_NUM if c not in PROFILE_COLS]


def _quality_sql():
    parts = []
    for c in QUALITY_COLS:
        t = f"CAST({c} AS STRING)"
        number = c in QUALITY_NUM
        quartiles = ", ".join(f"round(quantile_cont({c}, {q}), 6) AS q{round(100 * q)}" if number else f"CAST(NULL AS DOUBLE) AS q{round(100 * q)}"
                              for q in (0.25, 0.5, 0.75))
        strongest = "(SELECT {} FROM pairs WHERE a = '" + c + "' AND r IS NOT NULL ORDER BY round(abs(r), 12) DESC, b LIMIT 1)"
        parts.append(f"""SELECT '{c}' AS column_name, count(*) AS n_rows, count({c}) AS n_present,
          count(*) FILTER (WHERE {c} IS NULL) AS n_missing,
          round(count(*) FILTER (WHERE {c} IS NULL) * 100.0 / count(*), 6) AS pct_missing,
          count(DISTINCT {c}) AS n_distinct, min({t}) AS min_text, max({t}) AS max_text,
          (SELECT v FROM (SELECT {t} AS v, count(*) AS k FROM p01 WHERE {c} IS NOT NULL GROUP BY 1)
             ORDER BY k DESC, v LIMIT 1) AS most_common,
          (SELECT max(k) FROM (SELECT count(*) AS k FROM p01 WHERE {c} IS NOT NULL GROUP BY {c})) AS most_common_n,
          {quartiles}, {strongest.format("b")} AS corr_with, round({strongest.format("r")}, 6) AS corr
          FROM p01""")
    pairs = " UNION ALL ".join(f"SELECT '{a}' AS a, '{b}' AS b, corr({a}, {b}) AS r FROM p01" for a in QUALITY_NUM for b in QUALITY_NUM if a != b)
    return with_ctes(" UNION ALL ".join(parts), **ENC, pairs=pairs)


@register("quality_profile", _quality_sql())
def q_quality_profile(spark, sf_dir):
    out = PR.quality_profile(_raw_enc(spark, sf_dir), QUALITY_COLS, QUALITY_NUM)
    return out.select(F.col("column").alias("column_name"), "n_rows", "n_present", "n_missing",
                      r6("pct_missing").alias("pct_missing"), "n_distinct", "min_text", "max_text",
                      "most_common", "most_common_n", r6("q25").alias("q25"), r6("q50").alias("q50"), r6("q75").alias("q75"),
                      "corr_with", r6("corr").alias("corr"))


@register("missing_nonzero", with_ctes("SELECT * FROM (" + " UNION ALL ".join(_missing_parts()) + ") WHERE n_missing > 0", **ENC))
def q_missing_nonzero(spark, sf_dir):
    """Only the columns that lack values."""
    out = PR.missing_profile(_raw_enc(spark, sf_dir), PROFILE_COLS, nonzero_only=True)
    return out.select(F.col("column").alias("column_name"), "n_missing", r6("pct_missing").alias("pct_missing"))


@register("null_assert", with_ctes(" UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS n_null, "
    f"count(*) FILTER (WHERE {c} IS NULL) = 0 AS ok FROM p01" for c in PROFILE_COLS + ["encounter_id"]), **ENC))
def q_null_assert(spark, sf_dir):
    out = PR.null_assert(_raw_enc(spark, sf_dir), PROFILE_COLS + ["encounter_id"])
    return out.select(F.col("column").alias("column_name"), "n_null", "ok")


def _listing_sql():
    counts = " UNION ALL ".join(f"SELECT '{c}' AS column_name, count({c}) AS n_present FROM orders" for c in ORDER_COLS)
    return f"""
SELECT column_name, data_type, column_name IN ('o_orderkey', 'o_custkey', 'o_totalprice') AS is_numeric, position, n_present
FROM (SELECT column_name, CAST(row_number() OVER () - 1 AS INT) AS position, CASE column_type WHEN 'BIGINT' THEN 'bigint' WHEN 'DOUBLE' THEN 'double'
        WHEN 'VARCHAR' THEN 'string' WHEN 'TIMESTAMP' THEN 'timestamp_ntz' ELSE lower(column_type) END AS data_type
      FROM (DESCRIBE orders)) JOIN ({counts}) USING (column_name)
"""


ORDER_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]


@register("schema_listing", _listing_sql())
def q_schema_listing(spark, sf_dir):
    """Columns with type, numeric role and number of values."""
    od = read_table(spark, sf_dir, "orders")
    numeric = set(C.numeric_columns(od))
    roles = spark.createDataFrame([(f.name, f.dataType.simpleString(), f.name in numeric, i) for i, f in enumerate(od.schema.fields)],
                                  "column string, data_type string, is_numeric boolean, position int")
    rows = od.agg(F.count(F.lit(1))).scalar()
    return (roles.join(PR.missing_profile(od), "column")
            .select(F.col("column").alias("column_name"), "data_type", "is_numeric", "position", (rows - F.col("n_missing")).alias("n_present")))


@register("preview_head", "SELECT * FROM orders ORDER BY o_orderkey LIMIT 5")
def q_preview_head(spark, sf_dir):
    """The first rows by key (a preview; the limit is the feature)."""
    return read_table(spark, sf_dir, "orders").orderBy("o_orderkey").limit(5)
