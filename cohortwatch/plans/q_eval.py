"""Queries: evaluation, parity and leaderboards."""

from __future__ import annotations

from pyspark.sql import functions as F

from cohortwatch import schemas as S
from cohortwatch.operators import evaluate as EV
from cohortwatch.operators import split as SP
from cohortwatch.plans.fixtures import LINE_TARGET_SQL, SCORED_SQL, fixture, line_target, read_table, scored
from cohortwatch.plans.q_split import md5_sql
from cohortwatch.plans.registry import register, with_ctes

# Recorded baseline metrics of the reference model (parity targets).
RECORDED = {"f1_score": 0.436, "auc_roc": 0.648, "precision": 0.563, "recall": 0.355}

SC = dict(sc0=SCORED_SQL, sc="SELECT *, CASE WHEN score >= 0.5 THEN 1 ELSE 0 END AS pred FROM sc0")

# four "models": orders columns scaled to [0, 1], in long form
MODELS_SQL = """
SELECT 'm_price' AS model, o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS label,
       o_totalprice / 500000.0 AS score FROM orders
UNION ALL SELECT 'm_priority', o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END,
       CAST(substr(o_orderpriority, 1, 1) AS DOUBLE) / 5.0 FROM orders
UNION ALL SELECT 'm_customer', o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END,
       (o_custkey % 100) / 100.0 FROM orders
UNION ALL SELECT 'm_date', o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END,
       CAST(dayofyear(o_orderdate) AS DOUBLE) / 366.0 FROM orders
"""
MODELS = dict(m0=MODELS_SQL, m="SELECT *, CASE WHEN score >= 0.5 THEN 1 ELSE 0 END AS pred FROM m0")


def r6(c):
    return F.round(c, 6)


def _scored(spark, sf_dir):
    return scored(spark, sf_dir).withColumn("pred", EV.threshold_class("score", S.PREDICTION_THRESHOLD))


def _models(spark, sf_dir):
    return fixture(spark, sf_dir, MODELS_SQL, ["orders"]).withColumn(
        "pred", EV.threshold_class("score", S.PREDICTION_THRESHOLD))


@register("threshold_class", with_ctes("SELECT l_orderkey, l_linenumber, score, pred FROM sc", **SC))
def q_threshold_class(spark, sf_dir):
    return _scored(spark, sf_dir).select("l_orderkey", "l_linenumber", "score", "pred")


@register("confusion", with_ctes("SELECT label, pred, count(*) AS n FROM sc GROUP BY label, pred", **SC))
def q_confusion(spark, sf_dir):
    return EV.confusion(_scored(spark, sf_dir), "label", "pred")


METRICS_SQL = """
SELECT tp, fp, fn, tn,
  round(CASE WHEN tp + fp = 0 THEN 0 ELSE tp * 1.0 / (tp + fp) END, 6) AS precision,
  round(CASE WHEN tp + fn = 0 THEN 0 ELSE tp * 1.0 / (tp + fn) END, 6) AS recall,
  round(CASE WHEN 2 * tp + fp + fn = 0 THEN 0 ELSE 2.0 * tp / (2 * tp + fp + fn) END, 6) AS f1,
  round((tp + tn) * 1.0 / (tp + tn + fp + fn), 6) AS accuracy
FROM (SELECT count(*) FILTER (WHERE label = 1 AND pred = 1) AS tp, count(*) FILTER (WHERE label = 0 AND pred = 1) AS fp,
             count(*) FILTER (WHERE label = 1 AND pred = 0) AS fn, count(*) FILTER (WHERE label = 0 AND pred = 0) AS tn
      FROM sc)
"""


def _round_metrics(df, keep=()):
    return df.select(*keep, "tp", "fp", "fn", "tn", *[r6(c).alias(c) for c in ["precision", "recall", "f1", "accuracy"]])


@register("class_metrics", with_ctes(METRICS_SQL, **SC))
def q_class_metrics(spark, sf_dir):
    return _round_metrics(EV.binary_metrics(_scored(spark, sf_dir), "label", "pred"))


@register("class_report", with_ctes("""
SELECT class_name, support, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1 FROM per
UNION ALL SELECT 'accuracy', CAST(sum(support) AS BIGINT), NULL, NULL, round(sum(tp) * 1.0 / sum(support), 6) FROM per
UNION ALL SELECT 'macro avg', CAST(sum(support) AS BIGINT), round(avg(precision), 6), round(avg(recall), 6), round(avg(f1), 6) FROM per
UNION ALL SELECT 'weighted avg', CAST(sum(support) AS BIGINT), round(sum(precision * support) / sum(support), 6),
  round(sum(recall * support) / sum(support), 6), round(sum(f1 * support) / sum(support), 6) FROM per
""", **SC, per="""
  SELECT CAST(c AS VARCHAR) AS class_name, support,
    CASE WHEN predicted = 0 THEN 0 ELSE tp * 1.0 / predicted END AS precision,
    CASE WHEN support = 0 THEN 0 ELSE tp * 1.0 / support END AS recall,
    CASE WHEN predicted + support = 0 THEN 0 ELSE 2.0 * tp / (predicted + support) END AS f1, tp
  FROM (SELECT c, (SELECT count(*) FROM sc WHERE label = c) AS support,
               (SELECT count(*) FROM sc WHERE pred = c) AS predicted,
               (SELECT count(*) FROM sc WHERE pred = c AND label = c) AS tp
        FROM (SELECT label AS c FROM sc UNION SELECT pred FROM sc))"""))
def q_class_report(spark, sf_dir):
    rep = EV.class_report(_scored(spark, sf_dir), "label", "pred")
    return rep.select("class_name", "support", r6("precision").alias("precision"), r6("recall").alias("recall"),
                      r6("f1").alias("f1"))


def auc_sql(src: str, by: str | None = None) -> str:
    part = f"PARTITION BY {by} " if by else ""
    sel = f"{by}, " if by else ""
    grp = f"GROUP BY {by}" if by else ""
    return f"""
SELECT {sel}CAST(sum(pos) AS BIGINT) AS n_pos, CAST(sum(neg) AS BIGINT) AS n_neg,
  round(sum(pos * (neg_below + 0.5 * neg)) / (CAST(sum(pos) AS DOUBLE) * CAST(sum(neg) AS DOUBLE)), 6) AS auc
FROM (SELECT {sel}score, pos, neg,
        COALESCE(sum(neg) OVER ({part}ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS neg_below
      FROM (SELECT {sel}score, CAST(sum(label) AS DOUBLE) AS pos, CAST(sum(1 - label) AS DOUBLE) AS neg
            FROM {src} GROUP BY {sel}score))
{grp}
"""


@register("roc_auc", with_ctes(auc_sql("sc"), **SC))
def q_roc_auc(spark, sf_dir):
    auc = EV.roc_auc(_scored(spark, sf_dir), "label", "score")
    return auc.select("n_pos", "n_neg", r6("auc").alias("auc"))


@register("max_abs_diff", """
SELECT o.o_orderstatus, count(*) AS n, round(max(abs(o.o_totalprice / 1000.0 - l.ext / 1000.0)), 6) AS max_abs_diff
FROM orders o JOIN (SELECT l_orderkey, sum(l_extendedprice) AS ext FROM lineitem GROUP BY l_orderkey) l
  ON o.o_orderkey = l.l_orderkey
GROUP BY o.o_orderstatus
""")
def q_max_abs_diff(spark, sf_dir):
    """Two scorings of the same orders, attached by key (positions do not exist)."""
    od = read_table(spark, sf_dir, "orders")
    li = read_table(spark, sf_dir, "lineitem")
    a = od.select("o_orderkey", "o_orderstatus", (F.col("o_totalprice") / 1000.0).alias("sa"))
    b = li.groupBy("l_orderkey").agg((F.sum("l_extendedprice") / 1000.0).alias("sb")).withColumnRenamed(
        "l_orderkey", "o_orderkey")
    out = EV.paired_diff(a, b, ["o_orderkey"], "sa", "sb", by=["o_orderstatus"])
    return out.select("o_orderstatus", "n", r6("max_abs_diff").alias("max_abs_diff"))


@register("replay_parity", """
SELECT count(*) AS n, round(max(abs(l_extendedprice * (1 - l_discount) - (l_extendedprice - l_extendedprice * l_discount))), 6)
    AS max_abs_diff,
  max(abs(l_extendedprice * (1 - l_discount) - (l_extendedprice - l_extendedprice * l_discount))) <= 1e-9 AS passed
FROM lineitem
""")
def q_replay_parity(spark, sf_dir):
    """A replayed computation must equal the original within 1e-9 on every row."""
    li = read_table(spark, sf_dir, "lineitem")
    both = li.select((F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("orig"),
                     (F.col("l_extendedprice") - F.col("l_extendedprice") * F.col("l_discount")).alias("replay"))
    out = EV.row_diff(both, "orig", "replay", tolerance=S.REPLAY_TOLERANCE)
    return out.select("n", r6("max_abs_diff").alias("max_abs_diff"), "passed")


@register("group_align", with_ctes("""
SELECT COALESCE(a.l_linenumber, b.l_linenumber) AS l_linenumber, a.n, b.rate
FROM (SELECT l_linenumber, count(*) AS n FROM lt GROUP BY l_linenumber) a
FULL OUTER JOIN (SELECT l_linenumber, round(avg(target), 6) AS rate FROM lt WHERE l_quantity > 48 GROUP BY l_linenumber) b
  ON a.l_linenumber = b.l_linenumber
""", lt=LINE_TARGET_SQL))
def q_group_align(spark, sf_dir):
    li = line_target(spark, sf_dir)
    a = li.groupBy("l_linenumber").agg(F.count(F.lit(1)).alias("n"))
    b = li.filter(F.col("l_quantity") > 48).groupBy("l_linenumber").agg(r6(F.avg("target")).alias("rate"))
    return EV.align_groups(a, b, "l_linenumber")


@register("metric_parity", with_ctes("""
SELECT live.metric, round(live.value, 6) AS live, CAST(rec.value AS DOUBLE) AS recorded,
  round(abs(live.value - rec.value), 6) AS delta, abs(live.value - rec.value) <= 0.02 AS within
FROM live JOIN rec ON live.metric = rec.metric
""", **SC, met=METRICS_SQL.replace("round(", "(").replace(", 6)", ")"),
    auc=auc_sql("sc").replace("round(", "(").replace(", 6)", ")"),
    live="""SELECT 'f1_score' AS metric, f1 AS value FROM met UNION ALL SELECT 'precision', precision FROM met
      UNION ALL SELECT 'recall', recall FROM met UNION ALL SELECT 'auc_roc', auc FROM auc""",
    rec=f"""SELECT * FROM (VALUES {", ".join(f"('{k}', {v})" for k, v in RECORDED.items())}) t(metric, value)"""))
def q_metric_parity(spark, sf_dir):
    """Live F1/AUC/precision/recall vs the recorded baseline, absolute 0.02."""
    sc = _scored(spark, sf_dir)
    m = EV.binary_metrics(sc, "label", "pred")
    auc = EV.roc_auc(sc, "label", "score")
    live = (EV.metrics_long(m.select(F.col("f1").alias("f1_score"), "precision", "recall"), [],
                            ["f1_score", "precision", "recall"])
            .unionByName(auc.select(F.lit("auc_roc").alias("metric"), F.col("auc").alias("value"))))
    par = EV.metric_parity(live, EV.recorded_metrics(spark, RECORDED), S.PARITY_TOLERANCE)
    return par.select("metric", r6("live").alias("live"), "recorded", r6("delta").alias("delta"), "within")


def _leaderboard(spark, sf_dir):
    m = _models(spark, sf_dir)
    met = EV.binary_metrics(m, "label", "pred", by=["model"])
    auc = EV.roc_auc(m, "label", "score", by=["model"])
    wide = met.join(auc.select("model", "auc"), "model").select(
        "model", F.col("auc").alias("AUC"), F.col("f1").alias("F1"), F.col("precision").alias("Prec."),
        F.col("recall").alias("Recall"), F.col("accuracy").alias("Accuracy"))
    return wide


LEADER_SQL = f"""
SELECT a.model, a.auc, b.f1, b.precision, b.recall, b.accuracy FROM ({auc_sql('m', 'model').replace('round(', '(').replace(', 6)', ')')}) a
JOIN (SELECT model, CASE WHEN tp + fp = 0 THEN 0 ELSE tp * 1.0 / (tp + fp) END AS precision,
        CASE WHEN tp + fn = 0 THEN 0 ELSE tp * 1.0 / (tp + fn) END AS recall,
        CASE WHEN 2 * tp + fp + fn = 0 THEN 0 ELSE 2.0 * tp / (2 * tp + fp + fn) END AS f1,
        (tp + tn) * 1.0 / (tp + tn + fp + fn) AS accuracy
      FROM (SELECT model, count(*) FILTER (WHERE label = 1 AND pred = 1) AS tp,
              count(*) FILTER (WHERE label = 0 AND pred = 1) AS fp, count(*) FILTER (WHERE label = 1 AND pred = 0) AS fn,
              count(*) FILTER (WHERE label = 0 AND pred = 0) AS tn FROM m GROUP BY model)) b ON a.model = b.model
"""


@register("leaderboard_unpivot", with_ctes("""
SELECT model, metric, round(value, 6) AS value FROM (
  SELECT model, 'auc' AS metric, auc AS value FROM lb UNION ALL SELECT model, 'f1', f1 FROM lb
  UNION ALL SELECT model, 'prec', precision FROM lb UNION ALL SELECT model, 'recall', recall FROM lb
  UNION ALL SELECT model, 'accuracy', accuracy FROM lb)
""", **MODELS, lb=LEADER_SQL))
def q_leaderboard_unpivot(spark, sf_dir):
    """Wide leaderboard -> normalised names -> (model, metric, value)."""
    wide = EV.rename_metrics(_leaderboard(spark, sf_dir))
    long = EV.metrics_long(wide, ["model"], [c for c in wide.columns if c != "model"])
    return long.select("model", "metric", r6("value").alias("value"))


@register("rank_models", with_ctes("""
SELECT model, round(auc, 6) AS auc, row_number() OVER (ORDER BY auc DESC, model) AS rank,
  (SELECT round(auc, 6) FROM lb WHERE model = 'm_price') AS auc_lookup
FROM lb
""", **MODELS, lb=LEADER_SQL))
def q_rank_models(spark, sf_dir):
    """Rank models by AUC (W10) and read one cell by model and column."""
    wide = _leaderboard(spark, sf_dir)
    ranked = EV.rank_by(wide, "AUC", tie="model").select("model", r6("AUC").alias("auc"), "rank")
    cell = EV.lookup(wide, "model", "m_price", "AUC").select(r6("AUC").alias("auc_lookup"))
    return ranked.withColumn("auc_lookup", cell.scalar())


@register("fold_means", with_ctes(f"""
SELECT model, round(avg(f1), 6) AS mean_f1, round(avg(accuracy), 6) AS mean_accuracy, count(*) AS n_folds FROM (
  SELECT model, fold,
    CASE WHEN 2 * tp + fp + fn = 0 THEN 0 ELSE 2.0 * tp / (2 * tp + fp + fn) END AS f1,
    (tp + tn) * 1.0 / (tp + tn + fp + fn) AS accuracy
  FROM (SELECT model, fold, count(*) FILTER (WHERE label = 1 AND pred = 1) AS tp,
          count(*) FILTER (WHERE label = 0 AND pred = 1) AS fp, count(*) FILTER (WHERE label = 1 AND pred = 0) AS fn,
          count(*) FILTER (WHERE label = 0 AND pred = 0) AS tn
        FROM (SELECT m.*, CAST((row_number() OVER (PARTITION BY model, label ORDER BY {md5_sql('o_orderkey')}, o_orderkey)
                                - 1) % 10 AS INT) AS fold FROM m)
        GROUP BY model, fold))
GROUP BY model
""", **MODELS))
def q_fold_means(spark, sf_dir):
    """Per model, metrics per stratified fold, then the mean over folds."""
    m = _models(spark, sf_dir)
    folded = SP.hash_rank(m, "o_orderkey", S.SPLIT_SEED, ["model", "label"]).withColumn(
        "fold", ((F.col("__rank") - 1) % S.N_FOLDS).cast("int"))
    per_fold = EV.binary_metrics(folded, "label", "pred", by=["model", "fold"])
    return per_fold.groupBy("model").agg(r6(F.avg("f1")).alias("mean_f1"), r6(F.avg("accuracy")).alias("mean_accuracy"),
                                         F.count(F.lit(1)).alias("n_folds"))
