"""Queries: sources and sinks round-trips in the shared folder."""

from __future__ import annotations

import os

from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortwatch import schemas as S
from cohortwatch.operators import clean as C
from cohortwatch.operators import corrupt as X
from cohortwatch.operators import evaluate as EV
from cohortwatch.plans import q_eval, q_scenario
from cohortwatch.plans.fixtures import ENCOUNTERS_SQL, encounters, read_table
from cohortwatch.plans.q_clean import FEATURE_CTES, P01_SQL, feature_table
from cohortwatch.plans.q_scenario import COLS, KEY, SEED, SPLIT_CTES, _split
from cohortwatch.plans.registry import register, with_ctes
from cohortwatch.session import shared_path
from cohortwatch.sources import io as IO


def _folder(spark, name):
    return shared_path(spark, "io", name)


@register("csv_roundtrip", with_ctes("SELECT * FROM p01", enc=ENCOUNTERS_SQL, p01=P01_SQL))
def q_csv_roundtrip(spark, sf_dir):
    """K01 -> A01: headered CSV out and back with a fixed schema, NA spellings and '?' -> null."""
    raw = encounters(spark, sf_dir)
    path = _folder(spark, "csv")
    IO.write_csv(raw, path)
    back = IO.read_csv(spark, path, raw.schema)
    return C.placeholder_to_null(back, S.PLACEHOLDER)


@register("parquet_roundtrip", with_ctes("SELECT * EXCLUDE (dx) FROM feat", **FEATURE_CTES))
def q_parquet_roundtrip(spark, sf_dir):
    """K02 -> A02."""
    path = _folder(spark, "parquet")
    IO.write_parquet(feature_table(spark, sf_dir), path)
    return spark.read.parquet(path)


@register("write_ignore", with_ctes(f"SELECT {KEY}, {S.TARGET}, age_ordinal FROM feat", **FEATURE_CTES))
def q_write_ignore(spark, sf_dir):
    """The first write wins; a second, different write is ignored."""
    path = _folder(spark, "ignore")
    feats = feature_table(spark, sf_dir).select(KEY, S.TARGET, "age_ordinal")
    IO.load_or_materialise(spark, lambda: feats, path)
    IO.write_if_absent(feats.filter(F.col(S.TARGET) == 1), path)
    return spark.read.parquet(path)


AGG_SQL = """SELECT scenario, count(*) AS n, CAST(sum(num_lab_procedures) AS BIGINT) AS sum_labs,
  CAST(sum(time_in_hospital) AS BIGINT) AS sum_stay, count(DISTINCT gender) AS n_gender FROM corrupted GROUP BY scenario"""


def _corrupted(spark, sf_dir):
    sp = _split(spark, sf_dir)
    test = sp.filter(F.col("split") == "test").drop("split")
    return X.corrupt_all(test, KEY, SEED).select(*COLS, "scenario")


def _scenario_aggs(df):
    return df.groupBy("scenario").agg(F.count(F.lit(1)).alias("n"), F.sum("num_lab_procedures").cast("long")
                                      .alias("sum_labs"), F.sum("time_in_hospital").cast("long").alias("sum_stay"),
                                      F.count_distinct("gender").alias("n_gender"))


@register("multi_file_scenario", with_ctes(AGG_SQL, **SPLIT_CTES))
def q_multi_file_scenario(spark, sf_dir):
    """Scenario files written per scenario, read back by one glob; name from the path."""
    path = _folder(spark, "drifted")
    corrupted = _corrupted(spark, sf_dir)
    corrupted.write.mode("overwrite").partitionBy("scenario").option("header", True).csv(path)
    schema = T.StructType([f for f in corrupted.schema.fields if f.name != "scenario"])
    back = IO.read_scenario_files(spark, path, schema)
    return _scenario_aggs(back)


@register("partitioned_write", with_ctes(AGG_SQL, **SPLIT_CTES))
def q_partitioned_write(spark, sf_dir):
    """One Parquet folder per scenario; read back with partition discovery."""
    path = _folder(spark, "partitioned")
    IO.write_parquet(_corrupted(spark, sf_dir), path, partition_by=["scenario"])
    return _scenario_aggs(spark.read.parquet(path))


@register("json_document", with_ctes(q_eval.METRICS_SQL, **q_eval.SC))
def q_json_document(spark, sf_dir):
    """K05 -> A04: the metrics record as one JSON document and back."""
    path = _folder(spark, "metrics_json")
    m = q_eval._round_metrics(EV.binary_metrics(q_eval._scored(spark, sf_dir), "label", "pred"))
    IO.write_json_document(m, path)
    return IO.read_json_document(spark, path, m.schema)


RECORD_SCHEMA = T.StructType([T.StructField("event_id", T.LongType()), T.StructField("event_type", T.StringType()),
                              T.StructField("value", T.DoubleType())])


@register("json_records", """
SELECT event_id, event_type, CASE WHEN event_type = 'view' THEN NULL ELSE value END AS value FROM events
""")
def q_json_records(spark, sf_dir):
    """Request documents of up to 100 records; some records lack a field, all carry an unknown one."""
    ev = read_table(spark, sf_dir, "events")
    rec = F.struct(F.col("event_id"), F.col("event_type"),
                   F.when(F.col("event_type") != "view", F.col("value")).alias("value"),
                   F.lit("x").alias("unknown_field"))
    docs = ev.groupBy(F.floor(F.col("event_id") / 100).alias("request_id")).agg(
        F.to_json(F.struct(F.collect_list(rec).alias("records"))).alias("body"))
    return IO.parse_records(docs, "body", RECORD_SCHEMA)


@register("report_tables", with_ctes("SELECT * FROM sm", **q_scenario.DRIFT_CTES, sm=q_scenario.ALERTS_SQL))
def q_report_tables(spark, sf_dir):
    """Scenario summary and leaderboard written as report tables; the summary read back."""
    folder = _folder(spark, "reports")
    IO.write_report_tables({"scenario_summary": q_scenario._summary(spark, sf_dir)}, folder)
    q_eval._leaderboard(spark, sf_dir).transform(EV.rename_metrics).write.mode("overwrite").option(
        "header", True).csv(os.path.join(folder, "leaderboard_csv"))
    return spark.read.parquet(os.path.join(folder, "scenario_summary"))


@register("leaderboard_csv", with_ctes("""
SELECT model, round(auc, 6) AS auc, round(f1, 6) AS f1, round(precision, 6) AS prec, round(recall, 6) AS recall, round(accuracy, 6) AS accuracy FROM lb
""", **q_eval.MODELS, lb=q_eval.LEADER_SQL))
def q_leaderboard_csv(spark, sf_dir):
    """The leaderboard written as a CSV report and read back by its header."""
    path = os.path.join(_folder(spark, "leaderboard"), "csv")
    wide = EV.rename_metrics(q_eval._leaderboard(spark, sf_dir))
    IO.write_csv(wide, path)
    back = IO.read_csv(spark, path, wide.schema)
    return back.select("model", *[F.round(c, 6).alias(c) for c in ("auc", "f1", "prec", "recall", "accuracy")])


@register("certify_metrics", with_ctes("""
SELECT metric, round(value, 6) AS recorded, round(value, 6) AS live, CAST(0.0 AS DOUBLE) AS delta, true AS within FROM live
""", **q_eval.SC, met=q_eval.METRICS_SQL.replace("round(", "(").replace(", 6)", ")"),
    auc=q_eval.auc_sql("sc").replace("round(", "(").replace(", 6)", ")"),
    live="""SELECT 'f1_score' AS metric, f1 AS value FROM met UNION ALL SELECT 'precision', precision FROM met
      UNION ALL SELECT 'recall', recall FROM met UNION ALL SELECT 'auc_roc', auc FROM auc"""))
def q_certify_metrics(spark, sf_dir):
    """Live metrics written as the new record, read back, checked against live."""
    sc = q_eval._scored(spark, sf_dir)
    m = EV.binary_metrics(sc, "label", "pred")
    auc = EV.roc_auc(sc, "label", "score")
    live = (EV.metrics_long(m.select(F.col("f1").alias("f1_score"), "precision", "recall"), [],
                            ["f1_score", "precision", "recall"])
            .unionByName(auc.select(F.lit("auc_roc").alias("metric"), F.col("auc").alias("value"))))
    path = _folder(spark, "record")
    IO.write_json_document(live, path)
    recorded = IO.read_json_document(spark, path, live.schema, multi_line=False)
    par = EV.metric_parity(live, recorded, S.PARITY_TOLERANCE)
    return par.select("metric", F.round("recorded", 6).alias("recorded"), F.round("live", 6).alias("live"),
                      F.round("delta", 6).alias("delta"), "within")
