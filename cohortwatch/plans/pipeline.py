"""Composed pipelines (E1, E3) over the clinical configuration.

E1 batch: raw -> clean -> features (both materialised once in the shared
folder) -> stratified split -> transform spec -> drift reference sample.
E3 offline anomaly check: the grouped scenario run of ``q_scenario``.
E2 (scoring + online drift) is the streaming pair ``stream_score`` /
``stream_rolling_drift``.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortwatch import schemas as S
from cohortwatch.operators import encode as EN
from cohortwatch.operators import split as SP
from cohortwatch.plans import q_clean, q_scenario
from cohortwatch.plans.fixtures import encounters
from cohortwatch.plans.q_split import md5_sql
from cohortwatch.plans.registry import register, with_ctes
from cohortwatch.session import shared_path
from cohortwatch.sources import io as IO

REF_ROWS = S.DRIFT_REFERENCE_ROWS


def batch_pipeline(spark: SparkSession, sf_dir: str, folder: str) -> tuple[dict[str, DataFrame], EN.TransformSpec]:
    """Every stage as a DataFrame; clean and features are written once and re-read."""
    raw = encounters(spark, sf_dir)
    clean = IO.load_or_materialise(spark, lambda: q_clean.clean_encounters(spark, sf_dir),
                                   os.path.join(folder, "clean"))
    feats = IO.load_or_materialise(spark, lambda: q_clean.feature_table(spark, sf_dir, clean),
                                   os.path.join(folder, "features"))
    sp = SP.stratified_split(feats.select(*q_scenario.COLS), S.ENTITY_KEY, S.TARGET, S.SPLIT_TEST_SIZE,
                             S.SPLIT_SEED)
    train = sp.filter(F.col("split") == "train").drop("split")
    test = sp.filter(F.col("split") == "test").drop("split")
    spec = EN.fit_spec(train, S.FEATURE_COLUMNS, S.NUMERIC_FEATURES, S.CATEGORICAL_FEATURES, "gender",
                       ["diag_1_category", "medical_specialty_grouped"])
    reference = SP.hash_sample(train, S.ENTITY_KEY, REF_ROWS, S.SPLIT_SEED).select(*S.FEATURE_COLUMNS)
    stages = {"raw": raw, "clean": clean, "features": feats, "train": train, "test": test,
              "drift_reference": reference}
    return stages, spec


@register("batch_pipeline", with_ctes(f"""
SELECT 'raw' AS stage, count(*) AS n_rows, 22 AS n_columns FROM enc
UNION ALL SELECT 'clean', count(*), 20 FROM clean
UNION ALL SELECT 'features', count(*), 25 FROM feat
UNION ALL SELECT 'train', count(*), 18 FROM train0
UNION ALL SELECT 'test', count(*), 18 FROM test
UNION ALL SELECT 'drift_reference', count(*), 16 FROM
  (SELECT * FROM train0 ORDER BY {md5_sql(S.ENTITY_KEY)}, {S.ENTITY_KEY} LIMIT {REF_ROWS})
""", **q_scenario.SPLIT_CTES))
def q_batch_pipeline(spark, sf_dir):
    """E1 composed: rows and columns of every stage."""
    stages, _ = batch_pipeline(spark, sf_dir, shared_path(spark, "pipeline"))
    out = None
    for name, df in stages.items():
        row = df.agg(F.count(F.lit(1)).alias("n_rows")).select(
            F.lit(name).alias("stage"), "n_rows", F.lit(len(df.columns)).alias("n_columns"))
        out = row if out is None else out.unionByName(row)
    return out
