"""Queries: splits, folds, samples, shuffles, batches, blends."""

from __future__ import annotations

from pyspark.sql import functions as F

from cohortwatch import schemas as S
from cohortwatch.operators import split as SP
from cohortwatch.plans.fixtures import read_table
from cohortwatch.plans.q_clean import FEATURE_CTES, feature_table
from cohortwatch.plans.registry import register, with_ctes

SEED = S.SPLIT_SEED


def md5_sql(key: str, seed=SEED, stream: str | None = None) -> str:
    tail = f"'|{seed}'" if stream is None else f"'|{seed}|{stream}'"
    return f"md5(CAST({key} AS VARCHAR) || {tail})"


def draw_sql(key: str, seed=SEED, stream: str = "") -> str:
    return f"CAST(('0x' || substr({md5_sql(key, seed, stream)}, 1, 15)) AS BIGINT)"


SPLIT_SQL = f"""
SELECT o_orderkey, o_orderstatus,
  CASE WHEN row_number() OVER (PARTITION BY o_orderstatus ORDER BY {md5_sql('o_orderkey')}, o_orderkey)
       <= round(count(*) OVER (PARTITION BY o_orderstatus) * 0.2) THEN 'test' ELSE 'train' END AS split
FROM orders
"""


@register("stratified_split", SPLIT_SQL)
def q_stratified_split(spark, sf_dir):
    od = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    return SP.stratified_split(od, "o_orderkey", "o_orderstatus", S.SPLIT_TEST_SIZE, SEED)


@register("stratified_folds", f"""
SELECT o_orderkey, o_orderstatus,
  CAST((row_number() OVER (PARTITION BY o_orderstatus ORDER BY {md5_sql('o_orderkey')}, o_orderkey) - 1) % 10 AS INT)
    AS fold
FROM orders
""")
def q_stratified_folds(spark, sf_dir):
    od = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    return SP.stratified_folds(od, "o_orderkey", "o_orderstatus", S.N_FOLDS, SEED)


@register("hash_sample", f"""
SELECT o_orderkey, o_custkey, o_totalprice FROM orders
ORDER BY {md5_sql('o_orderkey')}, o_orderkey LIMIT 1000
""")
def q_hash_sample(spark, sf_dir):
    od = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return SP.hash_sample(od, "o_orderkey", 1000, SEED)


NUMBERED_CUST = f"""SELECT c_custkey, row_number() OVER (ORDER BY {md5_sql('c_custkey')}, c_custkey) - 1 AS pos
  FROM customer"""


@register("sample_replace", f"""
SELECT d.draw_id, c.c_custkey
FROM (SELECT range AS draw_id, {draw_sql('range', SEED, 'draw')} % (SELECT count(*) FROM customer) AS pos
      FROM range(0, 2000)) d
JOIN ({NUMBERED_CUST}) c ON d.pos = c.pos
""")
def q_sample_replace(spark, sf_dir):
    cust = read_table(spark, sf_dir, "customer").select("c_custkey")
    return SP.sample_with_replacement(spark, cust, "c_custkey", 2000, SEED).select("draw_id", "c_custkey")


def _blend_side(status, n, stream):
    return f"""SELECT d.draw_id, o.o_orderkey, '{stream}' AS source
      FROM (SELECT range AS draw_id,
                   {draw_sql('range', SEED, stream)} % (SELECT count(*) FROM orders WHERE o_orderstatus = '{status}') AS pos
            FROM range(0, {n})) d
      JOIN (SELECT o_orderkey, row_number() OVER (ORDER BY {md5_sql('o_orderkey')}, o_orderkey) - 1 AS pos
            FROM orders WHERE o_orderstatus = '{status}') o ON d.pos = o.pos"""


@register("blend", f"""
SELECT draw_id, o_orderkey, source,
  row_number() OVER (ORDER BY {md5_sql("source || ':' || CAST(draw_id AS VARCHAR)")},
                     source || ':' || CAST(draw_id AS VARCHAR)) - 1 AS position
FROM ({_blend_side('F', 700, 'clean')} UNION ALL {_blend_side('O', 300, 'drifted')})
""")
def q_blend(spark, sf_dir):
    od = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    clean = od.filter(F.col("o_orderstatus") == "F").select("o_orderkey")
    drifted = od.filter(F.col("o_orderstatus") == "O").select("o_orderkey")
    return SP.blend(spark, clean, drifted, "o_orderkey", 1000, 0.3, SEED).select(
        "draw_id", "o_orderkey", "source", "position")


@register("batch_ids", f"""
SELECT o_orderkey, pos AS position, CAST(floor(pos / 2000) AS BIGINT) AS batch_id
FROM (SELECT o_orderkey, row_number() OVER (ORDER BY {md5_sql('o_orderkey')}, o_orderkey) - 1 AS pos FROM orders)
""")
def q_batch_ids(spark, sf_dir):
    od = read_table(spark, sf_dir, "orders").select("o_orderkey")
    return SP.batch_ids(SP.number_rows(od, "o_orderkey", SEED), "position", 2000).select(
        "o_orderkey", "position", "batch_id")


REF_ROWS = S.DRIFT_REFERENCE_ROWS
_feat_cols = ", ".join(S.FEATURE_COLUMNS)


@register("drift_reference", with_ctes(f"""
SELECT encounter_id, {_feat_cols} FROM (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY readmitted_binary ORDER BY {md5_sql('encounter_id')}, encounter_id) AS rk,
              count(*) OVER (PARTITION BY readmitted_binary) AS cn
    FROM feat) WHERE rk > round(cn * 0.2))
ORDER BY {md5_sql('encounter_id')}, encounter_id LIMIT {REF_ROWS}
""", **FEATURE_CTES))
def q_drift_reference(spark, sf_dir):
    """Training split of the feature table, seeded sample, feature columns."""
    feats = feature_table(spark, sf_dir)
    train = SP.stratified_split(feats, "encounter_id", S.TARGET, S.SPLIT_TEST_SIZE, SEED).filter(
        F.col("split") == "train")
    return SP.hash_sample(train, "encounter_id", REF_ROWS, SEED).select("encounter_id", *S.FEATURE_COLUMNS)
