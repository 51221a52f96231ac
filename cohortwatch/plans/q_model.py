"""Queries: Spark ML on the encoded feature table (M07-M13, M18, V06). Rows-only checks.

The training split of the feature table is encoded with the fitted transform
spec (16 -> 30-odd numeric columns), folds come from the stratified hash folds.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from cohortwatch import schemas as S
from cohortwatch.operators import encode as EN
from cohortwatch.operators import evaluate as EV
from cohortwatch.operators import model as ML
from cohortwatch.operators import split as SP
from cohortwatch.operators import trees as TR
from cohortwatch.plans.q_encode import _frames, _spec
from cohortwatch.plans.q_scenario import SPLIT_CTES
from cohortwatch.plans.q_split import md5_sql
from cohortwatch.plans.registry import register, with_ctes
from cohortwatch.session import cut_lineage, shared_path

KEY, LABEL, SEED = S.ENTITY_KEY, S.TARGET, S.SPLIT_SEED
CV_FOLDS = S.N_FOLDS
SEARCH_GRID = {"regParam": [0.0, 0.001, 0.01, 0.1, 1.0], "elasticNetParam": [0.0, 0.25, 0.5, 0.75, 1.0],
               "maxIter": [10, 25, 50], "fitIntercept": [True, False]}


def _encoded(spark, sf_dir):
    train, test = _frames(spark, sf_dir)
    spec = _spec(train)
    tr = cut_lineage(EN.apply_spec(train, spec, keep=[KEY, LABEL]))
    te = cut_lineage(EN.apply_spec(test, spec, keep=[KEY, LABEL]))
    return tr, te, spec


def _model(spark, sf_dir):
    tr, te, spec = _encoded(spark, sf_dir)
    return ML.train_gbt(tr, spec.output_columns, LABEL, SEED), tr, te, spec


@register("train_gbt")
def q_train_gbt(spark, sf_dir):
    """Boosted trees fitted on the training split, probabilities for the test split."""
    model, _, te, _ = _model(spark, sf_dir)
    out = ML.score(model, te, S.PREDICTION_THRESHOLD, keep=[KEY, LABEL])
    return out.select(KEY, LABEL, F.round("probability", 6).alias("probability"), "prediction")


def _batches(spark, sf_dir):
    model, tr, te, spec = _model(spark, sf_dir)
    ensemble = TR.export(model, spec.output_columns)
    scored = TR.score(ensemble, te, S.PREDICTION_THRESHOLD, keep=[KEY])
    batches = SP.batch_ids(SP.number_rows(scored, KEY, SEED), "position", 100)
    summary = ML.batch_summary(batches, "batch_id")
    empty = ML.batch_summary(scored.limit(0)).select(F.lit(-1).cast("long").alias("batch_id"), "n", "positive_ratio")
    # rank sanity: a record at the training maxima of the risk counts scores above the typical record
    typical = tr.agg(*[F.avg(c).alias(c) for c in spec.output_columns])
    risk = ["number_inpatient", "number_emergency", "number_diagnoses"]
    most = tr.agg(*[F.max(c).cast("double").alias(c) for c in risk]).first()
    risky = typical.withColumns({c: F.lit(most[c]) for c in risk})
    p = TR.score(ensemble, typical.withColumn("__k", F.lit("typical")).unionByName(
        risky.withColumn("__k", F.lit("high_risk"))), keep=["__k"]).collect()
    probs = {r["__k"]: r["probability"] for r in p}
    ok = bool(probs["high_risk"] >= probs["typical"])
    return summary.unionByName(empty).withColumn("rank_sanity_ok", F.lit(ok))


@register("score_batch")
def q_score_batch(spark, sf_dir):
    """Scored batches of 100 rows (hash order) with positive ratio; an empty batch; rank sanity."""
    return _batches(spark, sf_dir).select("batch_id", "n", F.round("positive_ratio", 6).alias("positive_ratio"), "rank_sanity_ok")


@register("score_batch_sizes", with_ctes("""
SELECT range AS batch_id, LEAST(100, (SELECT count(*) FROM test) - 100 * range) AS n, true AS ratio_ok
FROM range(0, CAST(ceil((SELECT count(*) FROM test) / 100) AS BIGINT))
UNION ALL SELECT -1, 0, true
""", **SPLIT_CTES))
def q_score_batch_sizes(spark, sf_dir):
    """The parts of the scored batches that do not depend on the fitted trees."""
    ratio = F.col("positive_ratio")
    sound = F.when(F.col("n") == 0, ratio.isNull()).otherwise(ratio.between(0, 1))
    return _batches(spark, sf_dir).select("batch_id", "n", sound.alias("ratio_ok"))


@register("score_checks", with_ctes("""
SELECT 'rows scored' AS check_name, count(*) AS n FROM test
UNION ALL SELECT 'probabilities outside 0 to 1', 0 UNION ALL SELECT 'predictions off the threshold', 0
UNION ALL SELECT 'scores of the loaded model that differ', 0 UNION ALL SELECT 'scores of the compiled trees that differ', 0
""", **SPLIT_CTES))
def q_score_checks(spark, sf_dir):
    """Every test row scored by the model, the reloaded one and its compiled trees; what differs by over 1e-9."""
    model, _, te, spec = _model(spark, sf_dir)
    loaded = ML.save_load(model, shared_path(spark, "models", "gbt"))
    compiled = TR.probability(TR.export(model, spec.output_columns)).alias("p_trees")
    both = (ML.score(model, te, S.PREDICTION_THRESHOLD, keep=[KEY]).withColumnRenamed("probability", "p")
            .join(ML.score(loaded, te, keep=[KEY]).select(KEY, F.col("probability").alias("p_loaded")), KEY)
            .join(te.select(KEY, compiled), KEY))
    differs = lambda c: F.count_if(~F.coalesce(F.abs(F.col(c) - F.col("p")) <= S.REPLAY_TOLERANCE, F.lit(False)))
    counts = {"rows scored": F.count(F.lit(1)), "probabilities outside 0 to 1": F.count_if(~F.coalesce(F.col("p").between(0, 1), F.lit(False))),
              "predictions off the threshold": F.count_if((F.col("p") >= S.PREDICTION_THRESHOLD).cast("int") != F.col("prediction")),
              "scores of the loaded model that differ": differs("p_loaded"), "scores of the compiled trees that differ": differs("p_trees")}
    one = both.agg(*[c.alias(f"c{i}") for i, c in enumerate(counts.values())])
    return one.select(F.inline(F.array(*[F.struct(F.lit(name).alias("check_name"), F.col(f"c{i}").alias("n")) for i, name in enumerate(counts)])))


@register("leaderboard")
def q_leaderboard(spark, sf_dir):
    """Six Spark ML candidates by cross-validated AUC over stratified folds."""
    tr, _, spec = _encoded(spark, sf_dir)
    folded = cut_lineage(SP.stratified_folds(tr, KEY, LABEL, CV_FOLDS, SEED))
    return ML.leaderboard(folded, spec.output_columns, LABEL, "fold", CV_FOLDS, SEED)


@register("leaderboard_folds", with_ctes(f"""
SELECT model, fold, count(*) AS n_rows, CAST(sum({LABEL}) AS BIGINT) AS n_pos, true AS auc_in_range
FROM (SELECT {LABEL}, (row_number() OVER (PARTITION BY {LABEL} ORDER BY {md5_sql(KEY)}, {KEY}) - 1) % {CV_FOLDS} AS fold FROM train0),
  (VALUES ('decision_tree'), ('naive_bayes')) m(model)
GROUP BY model, fold
""", **SPLIT_CTES))
def q_leaderboard_folds(spark, sf_dir):
    """What each candidate scored in each fold, from the one table of held-out scores."""
    tr, _, spec = _encoded(spark, sf_dir)
    folded = cut_lineage(SP.stratified_folds(tr, KEY, LABEL, CV_FOLDS, SEED))
    some = {name: c for name, c in ML.candidates(LABEL, SEED).items() if name in ("decision_tree", "naive_bayes")}
    scores = ML.cross_scores(folded, spec.output_columns, LABEL, "fold", CV_FOLDS, some)
    out = EV.roc_auc(cut_lineage(scores), "label", "score", by=["model", "fold"])
    return out.select("model", F.col("fold").cast("long").alias("fold"), (F.col("n_pos") + F.col("n_neg")).alias("n_rows"), "n_pos",
                      F.coalesce(F.col("auc").between(0, 1), F.lit(False)).alias("auc_in_range"))


@register("random_search")
def q_random_search(spark, sf_dir):
    """25 seeded draws from a grid, cross-validated; 'chosen' marks the kept parameters."""
    tr, _, spec = _encoded(spark, sf_dir)
    folded = cut_lineage(SP.stratified_folds(tr, KEY, LABEL, CV_FOLDS, SEED))
    table, chosen = ML.random_search(folded, spec.output_columns, LABEL, "fold", CV_FOLDS, SEARCH_GRID,
                                      S.TUNING_DRAWS, SEED)
    chosen_text = "untuned" if not chosen else ", ".join(f"{k}={chosen[k]}" for k in sorted(chosen))
    return table.withColumn("chosen", F.col("params") == F.lit(chosen_text)).select(
        "draw", "params", F.round("auc", 6).alias("auc"), "chosen")


@register("feature_importance")
def q_feature_importance(spark, sf_dir):
    """Importances of the boosted trees, largest first."""
    model, _, _, spec = _model(spark, sf_dir)
    return ML.feature_importance(model, spec.output_columns, spark)


@register("model_roundtrip", with_ctes("SELECT count(*) AS n, 0.0::DOUBLE AS max_abs_diff, true AS passed FROM test", **SPLIT_CTES))
def q_model_roundtrip(spark, sf_dir):
    """Save, load, score both; probabilities must agree within 1e-9."""
    model, _, te, _ = _model(spark, sf_dir)
    loaded = ML.save_load(model, shared_path(spark, "models", "gbt"))
    a = ML.score(model, te, keep=[KEY]).withColumnRenamed("probability", "p_orig")
    b = ML.score(loaded, te, keep=[KEY]).withColumnRenamed("probability", "p_loaded")
    return EV.paired_diff(a, b, [KEY], "p_orig", "p_loaded", tolerance=S.REPLAY_TOLERANCE).withColumn("max_abs_diff", F.round("max_abs_diff", 9))


@register("scenario_summary_gbt")
def q_scenario_summary_gbt(spark, sf_dir):
    """E3 with the trained model: scenarios scored by the GBT pipeline, then the grouped drift summary.

    Reference = training split with its model predictions; current = the test
    split under every corruption (plus 'clean'), encoded with the spec fitted on
    the training split. Rows-only: the model is Spark ML's, not the original one.
    """
    from cohortwatch.operators import corrupt as X
    from cohortwatch.operators import drift as D
    from cohortwatch.plans.q_scenario import DRIFT_CAT, DRIFT_NUM
    from cohortwatch.functions.values import join_labels
    train, test = _frames(spark, sf_dir)
    spec = _spec(train)
    model = ML.train_gbt(cut_lineage(EN.apply_spec(train, spec, keep=[KEY, LABEL])), spec.output_columns, LABEL, SEED)

    def predicted(df, keys):
        enc = EN.apply_spec(df, spec, keep=keys)
        scored = ML.score(model, enc, S.PREDICTION_THRESHOLD, keep=keys)
        return df.join(scored.select(*keys, "prediction"), keys)

    ref = cut_lineage(predicted(train, [KEY]))
    cur = X.corrupt_all(test, KEY, SEED).unionByName(test.withColumn("scenario", F.lit("clean")))
    cur = cut_lineage(predicted(cur, [KEY, "scenario"]))
    table = D.drift_table(ref, cur, DRIFT_NUM, DRIFT_CAT, group="scenario")
    verdict = D.dataset_verdict(table, "scenario")
    pos = cur.groupBy("scenario").agg(F.avg("prediction").alias("pos_ratio"))
    baseline = pos.filter(F.col("scenario") == "clean").select("pos_ratio").scalar()
    delta = F.abs(F.col("pos_ratio") - baseline)
    alerts = join_labels(
        F.when(F.col("dataset_drift"), F.lit("DATASET_DRIFT")),
        F.when(F.col("n_drifted") >= 1, F.concat(F.col("n_drifted").cast("string"), F.lit("_COLS_DRIFTED"))),
        F.when(delta > S.PRED_SHIFT_ALERT_DELTA,
               F.concat(F.lit("PRED_SHIFT_"), F.format_string("%.2f", F.round(delta, 2)))))
    return (verdict.join(pos, "scenario").filter(F.col("scenario") != "clean")
            .select("scenario", "n_drifted", "n_columns", F.round("drift_share", 3).alias("drift_share"),
                    "dataset_drift", F.round("pos_ratio", 3).alias("pos_ratio"), F.round(delta, 3).alias("pos_delta"),
                    alerts.alias("alerts")))
