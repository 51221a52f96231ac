"""Queries: corruption scenarios and the grouped scenario run (X01-X05, V04, F12, F13, P11, P12, P14,
D10-D14, U03, G23, F17).

Reference = training split of the feature table (features + target + prediction);
current = the test split under each named corruption. Every scenario is a value
of the ``scenario`` column, so the whole run is one grouped job, not a loop.

Predictions come from a fixed linear risk score (threshold 0.5) so that the
scenario tables can be checked against SQL; the Spark ML models are scored in
``q_model``.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from cohortwatch import schemas as S
from cohortwatch.functions.values import join_labels
from cohortwatch.operators import corrupt as X
from cohortwatch.operators import drift as D
from cohortwatch.operators import evaluate as EV
from cohortwatch.operators import split as SP
from cohortwatch.plans.drift_sql import drift_ctes, verdict_sql
from cohortwatch.plans.q_clean import FEATURE_CTES, feature_table
from cohortwatch.plans.q_split import md5_sql, draw_sql
from cohortwatch.plans.registry import register, with_ctes
from cohortwatch.session import cut_lineage

SEED = S.SPLIT_SEED
KEY = S.ENTITY_KEY
COLS = [KEY] + S.FEATURE_COLUMNS + [S.TARGET]
DRIFT_NUM = S.NUMERIC_FEATURES
DRIFT_CAT = S.CATEGORICAL_FEATURES + [S.TARGET, "prediction"]
# Fixed linear risk score used as the scenario model: (column, weight), summed in this order.
RISK_WEIGHTS = [("number_inpatient", 0.08), ("number_emergency", 0.05), ("time_in_hospital", 0.03),
                ("number_diagnoses", 0.02)]


def r3(c):
    return F.round(c, 3)


def r6(c):
    return F.round(c, 6)


def risk_score():
    expr = None
    for c, w in RISK_WEIGHTS:
        term = F.col(c).cast("double") * F.lit(w)
        expr = term if expr is None else expr + term
    return expr


def _split(spark, sf_dir):
    feats = feature_table(spark, sf_dir).select(*COLS)
    return cut_lineage(SP.stratified_split(feats, KEY, S.TARGET, S.SPLIT_TEST_SIZE, SEED))


def _with_prediction(df):
    return df.withColumn("prediction", EV.threshold_class(risk_score(), S.PREDICTION_THRESHOLD))


def scenario_frames(spark, sf_dir):
    """(reference, current-with-scenario) frames; current holds 'clean' plus every corruption."""
    sp = _split(spark, sf_dir)
    train = sp.filter(F.col("split") == "train").drop("split")
    test = sp.filter(F.col("split") == "test").drop("split")
    current = X.corrupt_all(test, KEY, SEED).unionByName(test.withColumn("scenario", F.lit("clean")))
    return cut_lineage(_with_prediction(train)), cut_lineage(_with_prediction(current))


# ---- oracle text ----------------------------------------------------------

def _hint(stream, low, high):
    return f"({low} + {draw_sql(KEY, SEED, stream)} % {high - low})"


_RISK_SQL = " + ".join(f"CAST({c} AS DOUBLE) * CAST({w} AS DOUBLE)" for c, w in RISK_WEIGHTS)
_SEL = ", ".join(COLS)


def _replace(mapping):
    return ", ".join(f"{mapping.get(c, c)} AS {c}" for c in COLS)


def _clipped(expr: str, bounds: tuple[int, int]) -> str:
    return f"LEAST(GREATEST({expr}, {bounds[0]}), {bounds[1]})"


# the constants are those of the corruptions themselves
SCENARIO_SQL = {
    "out_of_bounds": _replace({
        "num_lab_procedures": f"num_lab_procedures * {X.OOB_LAB_SCALE} + {X.OOB_LAB_SHIFT}", "time_in_hospital": f"CAST({X.OOB_STAY} AS BIGINT)",
        "num_medications": _hint("out_of_bounds:meds", *X.OOB_MEDS_RANGE), "number_diagnoses": f"number_diagnoses + {X.OOB_DIAGNOSES_SHIFT}"}),
    "column_swap": _replace({**dict(X.SWAP_PAIRS), **{b: a for a, b in X.SWAP_PAIRS}}),
    "schema_change": _replace({
        "gender": f"CASE WHEN {draw_sql(KEY, SEED, 'schema_change:gender')} / 1152921504606846976.0 < {X.UNKNOWN_GENDER_SHARE} "
                  f"THEN '{X.UNKNOWN_GENDER}' ELSE gender END",
        "diag_1_category": f"{X.UNSEEN_DIAGNOSES}[{draw_sql(KEY, SEED, 'schema_change:diag')} % {len(X.UNSEEN_DIAGNOSES)} + 1]",
        "medical_specialty_grouped": f"'{X.UNSEEN_SPECIALTY}'"}),
    "dist_shift": _replace({
        "age_ordinal": f"CASE WHEN age_ordinal IS NOT NULL THEN {_clipped('age_ordinal + ' + _hint('dist_shift:age', *X.SHIFT_AGE), X.AGE_BOUNDS)} END",
        "time_in_hospital": _clipped("time_in_hospital + " + _hint("dist_shift:stay", *X.SHIFT_STAY), X.STAY_BOUNDS),
        "number_inpatient": f"number_inpatient + {_hint('dist_shift:inpatient', *X.SHIFT_INPATIENT)}",
        "number_emergency": f"number_emergency + {_hint('dist_shift:emergency', *X.SHIFT_EMERGENCY)}"}),
}

SPLIT_CTES = dict(
    FEATURE_CTES,
    sp=f"""SELECT {_SEL}, CASE WHEN row_number() OVER (PARTITION BY {S.TARGET} ORDER BY {md5_sql(KEY)}, {KEY})
        <= round(count(*) OVER (PARTITION BY {S.TARGET}) * 0.2) THEN 'test' ELSE 'train' END AS split FROM feat""",
    train0=f"SELECT {_SEL} FROM sp WHERE split = 'train'",
    test=f"SELECT {_SEL} FROM sp WHERE split = 'test'",
    corrupted=" UNION ALL ".join(f"SELECT {body}, '{name}' AS scenario FROM test" for name, body in SCENARIO_SQL.items()),
    cur0=f"SELECT * FROM corrupted UNION ALL SELECT {_SEL}, 'clean' AS scenario FROM test",
    ref=f"SELECT *, CASE WHEN {_RISK_SQL} >= 0.5 THEN 1 ELSE 0 END AS prediction FROM train0",
    cur=f"SELECT *, CASE WHEN {_RISK_SQL} >= 0.5 THEN 1 ELSE 0 END AS prediction FROM cur0",
)
DRIFT_CTES = dict(SPLIT_CTES, **drift_ctes("ref", "cur", DRIFT_NUM, DRIFT_CAT, "scenario"),
                  verdict=verdict_sql(),
                  pos="SELECT scenario, avg(prediction) AS pos_ratio FROM cur GROUP BY scenario",
                  base="SELECT pos_ratio AS baseline FROM pos WHERE scenario = 'clean'")


def _corrupt_query(name):
    def q(spark, sf_dir):
        sp = _split(spark, sf_dir)
        test = sp.filter(F.col("split") == "test").drop("split")
        return X.SCENARIOS[name](test, KEY, SEED).select(*COLS)
    q.__name__ = f"q_corrupt_{name}"
    q.__doc__ = f"Corruption '{name}' of the clean test split."
    return q


for _name in X.SCENARIOS:
    register(f"corrupt_{_name}", with_ctes(f"SELECT {_SEL} FROM corrupted WHERE scenario = '{_name}'",
                                           **SPLIT_CTES))(_corrupt_query(_name))


@register("corrupt_all", with_ctes(f"SELECT {_SEL}, scenario FROM corrupted", **SPLIT_CTES))
def q_corrupt_all(spark, sf_dir):
    """Every named corruption of the base table, tagged with its scenario."""
    sp = _split(spark, sf_dir)
    test = sp.filter(F.col("split") == "test").drop("split")
    return X.corrupt_all(test, KEY, SEED).select(*COLS, "scenario")


def _scenario_tables(spark, sf_dir):
    ref, cur = scenario_frames(spark, sf_dir)
    dt = D.drift_table(ref, cur, DRIFT_NUM, DRIFT_CAT, group="scenario")
    verdict = D.dataset_verdict(dt, "scenario")
    pos = cur.groupBy("scenario").agg(F.avg("prediction").alias("pos_ratio"))
    baseline = pos.filter(F.col("scenario") == "clean").select("pos_ratio").scalar()
    return ref, cur, verdict, pos.withColumn("baseline", baseline)


@register("drift_with_performance", with_ctes(f"""
SELECT v.g AS scenario, v.n_columns, v.n_drifted, round(v.drift_share, 6) AS drift_share, v.dataset_drift,
  round(m.f1, 6) AS cur_f1, round(m.accuracy, 6) AS cur_accuracy,
  round(r.f1, 6) AS ref_f1, round(r.accuracy, 6) AS ref_accuracy
FROM verdict v
JOIN (SELECT scenario, CASE WHEN 2 * tp + fp + fn = 0 THEN 0 ELSE 2.0 * tp / (2 * tp + fp + fn) END AS f1,
        (tp + tn) * 1.0 / (tp + tn + fp + fn) AS accuracy
      FROM (SELECT scenario, count(*) FILTER (WHERE {S.TARGET} = 1 AND prediction = 1) AS tp,
              count(*) FILTER (WHERE {S.TARGET} = 0 AND prediction = 1) AS fp,
              count(*) FILTER (WHERE {S.TARGET} = 1 AND prediction = 0) AS fn,
              count(*) FILTER (WHERE {S.TARGET} = 0 AND prediction = 0) AS tn FROM cur GROUP BY scenario)) m
  ON v.g = m.scenario
CROSS JOIN (SELECT CASE WHEN 2 * tp + fp + fn = 0 THEN 0 ELSE 2.0 * tp / (2 * tp + fp + fn) END AS f1,
        (tp + tn) * 1.0 / (tp + tn + fp + fn) AS accuracy
      FROM (SELECT count(*) FILTER (WHERE {S.TARGET} = 1 AND prediction = 1) AS tp,
              count(*) FILTER (WHERE {S.TARGET} = 0 AND prediction = 1) AS fp,
              count(*) FILTER (WHERE {S.TARGET} = 1 AND prediction = 0) AS fn,
              count(*) FILTER (WHERE {S.TARGET} = 0 AND prediction = 0) AS tn FROM ref)) r
""", **DRIFT_CTES))
def q_drift_with_performance(spark, sf_dir):
    """18-column drift (features, target, prediction) plus quality on both sides, per scenario."""
    ref, cur, verdict, _ = _scenario_tables(spark, sf_dir)
    m = EV.binary_metrics(cur, S.TARGET, "prediction", by=["scenario"])
    r = EV.binary_metrics(ref, S.TARGET, "prediction")
    ref_f1 = r.select("f1").scalar()
    ref_acc = r.select("accuracy").scalar()
    return verdict.join(m, "scenario").select(
        "scenario", "n_columns", "n_drifted", r6("drift_share").alias("drift_share"), "dataset_drift",
        r6("f1").alias("cur_f1"), r6("accuracy").alias("cur_accuracy"),
        r6(ref_f1).alias("ref_f1"), r6(ref_acc).alias("ref_accuracy"))


@register("clean_no_drift", with_ctes("""
SELECT n_columns, n_drifted, round(drift_share, 6) AS drift_share, dataset_drift, NOT dataset_drift AS ok
FROM verdict WHERE g = 'clean'
""", **DRIFT_CTES))
def q_clean_no_drift(spark, sf_dir):
    """Clean train vs clean test must show no dataset drift."""
    _, _, verdict, _ = _scenario_tables(spark, sf_dir)
    return verdict.filter(F.col("scenario") == "clean").select(
        "n_columns", "n_drifted", r6("drift_share").alias("drift_share"), "dataset_drift",
        (~F.col("dataset_drift")).alias("ok"))


@register("prediction_shift", with_ctes(f"""
SELECT scenario, round(pos_ratio, 6) AS pos_ratio, round(baseline, 6) AS baseline,
  round(abs(pos_ratio - baseline), 6) AS pos_delta, abs(pos_ratio - baseline) > {S.PRED_SHIFT_ALERT_DELTA} AS alert
FROM pos, base
""", **DRIFT_CTES))
def q_prediction_shift(spark, sf_dir):
    """Positive-ratio shift against the clean baseline, alert above 0.10."""
    _, _, _, pos = _scenario_tables(spark, sf_dir)
    delta = F.abs(F.col("pos_ratio") - F.col("baseline"))
    return pos.select("scenario", r6("pos_ratio").alias("pos_ratio"), r6("baseline").alias("baseline"),
                      r6(delta).alias("pos_delta"), (delta > S.PRED_SHIFT_ALERT_DELTA).alias("alert"))


ALERTS_SQL = f"""
SELECT v.g AS scenario, v.n_drifted, v.n_columns, round(v.drift_share, 3) AS drift_share, v.dataset_drift,
  round(p.pos_ratio, 3) AS pos_ratio, round(abs(p.pos_ratio - b.baseline), 3) AS pos_delta,
  COALESCE(NULLIF(concat_ws(', ',
    CASE WHEN v.dataset_drift THEN 'DATASET_DRIFT' END,
    CASE WHEN v.n_drifted >= 1 THEN CAST(v.n_drifted AS VARCHAR) || '_COLS_DRIFTED' END,
    CASE WHEN abs(p.pos_ratio - b.baseline) > {S.PRED_SHIFT_ALERT_DELTA}
         THEN 'PRED_SHIFT_' || printf('%.2f', round(abs(p.pos_ratio - b.baseline), 2)) END), ''), '-') AS alerts
FROM verdict v JOIN pos p ON v.g = p.scenario CROSS JOIN base b
WHERE v.g <> 'clean'
"""


def _summary(spark, sf_dir):
    _, _, verdict, pos = _scenario_tables(spark, sf_dir)
    delta = F.abs(F.col("pos_ratio") - F.col("baseline"))
    alerts = join_labels(
        F.when(F.col("dataset_drift"), F.lit("DATASET_DRIFT")),
        F.when(F.col("n_drifted") >= 1, F.concat(F.col("n_drifted").cast("string"), F.lit("_COLS_DRIFTED"))),
        F.when(delta > S.PRED_SHIFT_ALERT_DELTA,
               F.concat(F.lit("PRED_SHIFT_"), F.format_string("%.2f", F.round(delta, 2)))))
    return (verdict.join(pos, "scenario").filter(F.col("scenario") != "clean")
            .select("scenario", "n_drifted", "n_columns", r3("drift_share").alias("drift_share"), "dataset_drift",
                    r3("pos_ratio").alias("pos_ratio"), r3(delta).alias("pos_delta"), alerts.alias("alerts")))


@register("scenario_alerts", with_ctes("SELECT scenario, alerts FROM sm", **DRIFT_CTES, sm=ALERTS_SQL))
def q_scenario_alerts(spark, sf_dir):
    """Alert list per scenario."""
    return _summary(spark, sf_dir).select("scenario", "alerts")


@register("scenario_summary", with_ctes("""
SELECT *, (SELECT count(*) FILTER (WHERE alerts <> '-') FROM sm) AS n_alerted,
  (SELECT count(*) FROM sm) AS n_scenarios FROM sm
""", **DRIFT_CTES, sm=ALERTS_SQL))
def q_scenario_summary(spark, sf_dir):
    """One row per scenario, plus how many scenarios raised an alert."""
    sm = _summary(spark, sf_dir)
    counts = sm.agg(F.count_if(F.col("alerts") != "-").alias("n_alerted"), F.count(F.lit(1)).alias("n_scenarios"))
    return sm.withColumns({"n_alerted": counts.select("n_alerted").scalar(),
                           "n_scenarios": counts.select("n_scenarios").scalar()})
