"""Model evaluation operators.

Metrics come from one aggregation of the scored rows; AUC is a rank-sum over
*grouped* scores, whose running count of negatives comes from ``scan.ordered_scan``,
so no task ever sees an unbounded number of distinct scores.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cohortwatch.operators.scan import ordered_scan



def _safe_div(a: Column, b: Column) -> Column:
    """a / b, 0 when b is 0 (sklearn's zero_division=0)."""
    return F.when(b == 0, F.lit(0.0)).otherwise(a.cast("double") / b)


def threshold_class(score: Column | str, threshold: float = 0.5) -> Column:
    """(p >= threshold) as 0/1."""
    s = F.col(score) if isinstance(score, str) else score
    return (s >= F.lit(threshold)).cast("int")


def confusion(df: DataFrame, label: str, pred: str) -> DataFrame:
    """(label, pred, n)."""
    return df.groupBy(F.col(label).alias("label"), F.col(pred).alias("pred")).agg(F.count(F.lit(1)).alias("n"))


def binary_metrics(df: DataFrame, label: str, pred: str, by: Sequence[str] = ()) -> DataFrame:
    """tp, fp, fn, tn, precision, recall, f1, accuracy for class 1."""
    y, p = F.col(label), F.col(pred)
    agg = df.groupBy(*by).agg(
        F.count_if((y == 1) & (p == 1)).alias("tp"), F.count_if((y == 0) & (p == 1)).alias("fp"),
        F.count_if((y == 1) & (p == 0)).alias("fn"), F.count_if((y == 0) & (p == 0)).alias("tn"))
    precision = _safe_div(F.col("tp"), F.col("tp") + F.col("fp"))
    recall = _safe_div(F.col("tp"), F.col("tp") + F.col("fn"))
    return agg.select(
        *by, "tp", "fp", "fn", "tn", precision.alias("precision"), recall.alias("recall"),
        _safe_div(2 * F.col("tp"), 2 * F.col("tp") + F.col("fp") + F.col("fn")).alias("f1"),
        _safe_div(F.col("tp") + F.col("tn"), F.col("tp") + F.col("tn") + F.col("fp") + F.col("fn")).alias("accuracy"))


def class_report(df: DataFrame, label: str, pred: str) -> DataFrame:
    """Per class precision/recall/f1/support, plus accuracy, macro and weighted averages."""
    cm = confusion(df, label, pred)
    by_label = cm.groupBy(F.col("label").alias("cls")).agg(F.sum("n").alias("support"),
                                                          F.sum(F.when(F.col("pred") == F.col("label"), F.col("n"))
                                                                .otherwise(0)).alias("tp"))
    by_pred = cm.groupBy(F.col("pred").alias("cls")).agg(F.sum("n").alias("predicted"))
    per = by_label.join(by_pred, "cls", "full_outer").select(
        F.col("cls").cast("string").alias("class_name"),
        F.coalesce("support", F.lit(0)).alias("support"),
        F.coalesce("tp", F.lit(0)).alias("tp"), F.coalesce("predicted", F.lit(0)).alias("predicted"))
    per = per.select("class_name", "support",
                     _safe_div(F.col("tp"), F.col("predicted")).alias("precision"),
                     _safe_div(F.col("tp"), F.col("support")).alias("recall"),
                     _safe_div(2 * F.col("tp"), F.col("predicted") + F.col("support")).alias("f1"),
                     F.col("tp"))
    summary = per.agg(
        F.sum("support").alias("n"), F.sum("tp").alias("tp_all"), F.count(F.lit(1)).alias("k"),
        F.avg("precision").alias("mp"), F.avg("recall").alias("mr"), F.avg("f1").alias("mf"),
        F.sum(F.col("precision") * F.col("support")).alias("wp"),
        F.sum(F.col("recall") * F.col("support")).alias("wr"),
        F.sum(F.col("f1") * F.col("support")).alias("wf"))
    avgs = summary.select(F.inline(F.array(
        F.struct(F.lit("accuracy").alias("class_name"), F.col("n").alias("support"),
                 F.lit(None).cast("double").alias("precision"), F.lit(None).cast("double").alias("recall"),
                 _safe_div(F.col("tp_all"), F.col("n")).alias("f1")),
        F.struct(F.lit("macro avg").alias("class_name"), F.col("n").alias("support"), F.col("mp").alias("precision"),
                 F.col("mr").alias("recall"), F.col("mf").alias("f1")),
        F.struct(F.lit("weighted avg").alias("class_name"), F.col("n").alias("support"),
                 (F.col("wp") / F.col("n")).alias("precision"), (F.col("wr") / F.col("n")).alias("recall"),
                 (F.col("wf") / F.col("n")).alias("f1")))))
    return per.drop("tp").unionByName(avgs)


def roc_auc(df: DataFrame, label: str, score: str, by: Sequence[str] = ()) -> DataFrame:
    """ROC AUC with tied scores counted one half (G18); one row per ``by`` group.

    Rows with a null label or a null or NaN score have no place in the ranking: they are
    left out, and ``n_skipped`` tells how many.
    """
    by = list(by)
    s = F.col(score).cast("double")
    fit = F.col(label).isNotNull() & s.isNotNull() & ~F.isnan(s)
    y = F.col(label).cast("long")
    skipped = df.groupBy(*by).agg(F.count_if(~fit).alias("n_skipped"))
    counts = df.where(fit).groupBy(*by, s.alias("__s")).agg(F.sum(y).alias("__pos"), F.sum(1 - y).alias("__neg"))
    scanned = ordered_scan(counts, by, "__s", ["__neg"], most=df.count())
    below = F.col("cum___neg") - F.col("__neg")
    area = F.col("__pos").cast("double") * (below + 0.5 * F.col("__neg"))
    out = scanned.groupBy(*by).agg(F.sum(area).alias("__a"), F.sum("__pos").alias("n_pos"), F.sum("__neg").alias("n_neg"))
    cond = [skipped[c].eqNullSafe(out[c]) for c in by] or F.lit(True)
    if by:
        out = skipped.join(out, cond, "left").select(*[skipped[c] for c in by], "n_pos", "n_neg", "n_skipped", "__a")
    else:
        out = out.withColumn("n_skipped", skipped.scalar())
    out = out.fillna(0, ["n_pos", "n_neg"])
    return out.select(*by, "n_pos", "n_neg", "n_skipped",
                      F.when((F.col("n_pos") == 0) | (F.col("n_neg") == 0), F.lit(None))
                      .otherwise(F.col("__a") / (F.col("n_pos").cast("double") * F.col("n_neg"))).alias("auc"))


def paired_diff(a: DataFrame, b: DataFrame, keys: Sequence[str], col_a: str, col_b: str,
                by: Sequence[str] = (), tolerance: float | None = None) -> DataFrame:
    """Join two scorings of the same rows; n, max |a - b|, within tolerance."""
    j = a.select(*keys, *by, F.col(col_a).alias("__a")).join(b.select(*keys, F.col(col_b).alias("__b")), list(keys))
    out = j.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.max(F.abs(F.col("__a") - F.col("__b"))).alias("max_abs_diff"))
    if tolerance is not None:
        out = out.withColumn("passed", F.col("max_abs_diff") <= F.lit(tolerance))
    return out


def row_diff(df: DataFrame, col_a: str, col_b: str, by: Sequence[str] = (),
             tolerance: float | None = None) -> DataFrame:
    """Both scorings already on one row: n, max |a - b|, within tolerance."""
    out = df.groupBy(*by).agg(F.count(F.lit(1)).alias("n"),
                              F.max(F.abs(F.col(col_a) - F.col(col_b))).alias("max_abs_diff"))
    if tolerance is not None:
        out = out.withColumn("passed", F.col("max_abs_diff") <= F.lit(tolerance))
    return out


def metrics_long(wide: DataFrame, id_cols: Sequence[str], metric_cols: Sequence[str]) -> DataFrame:
    """Unpivot wide metric columns to (id..., metric, value)."""
    typed = wide.select(*id_cols, *[F.col(c).cast("double").alias(c) for c in metric_cols])
    return typed.unpivot(list(id_cols), list(metric_cols), "metric", "value")


def metric_parity(live: DataFrame, recorded: DataFrame, tolerance: float) -> DataFrame:
    """Join live and recorded (metric, value) rows; delta and pass flag."""
    j = live.select("metric", F.col("value").alias("live")).join(
        recorded.select("metric", F.col("value").alias("recorded")), "metric", "inner")
    return j.withColumns({"delta": F.abs(F.col("live") - F.col("recorded"))}).withColumn(
        "within", F.col("delta") <= F.lit(tolerance))


def rank_by(df: DataFrame, metric: str, ascending: bool = False, tie: str | None = None) -> DataFrame:
    """Rank rows (models, features) by a metric (W10); a few rows, after aggregation."""
    order = F.col(metric).asc() if ascending else F.col(metric).desc()
    w = Window.orderBy(order, *([F.col(tie)] if tie else []))
    return df.withColumn("rank", F.row_number().over(w))


def lookup(df: DataFrame, key_col: str, key, value_col: str) -> DataFrame:
    """One cell by row key and column name."""
    return df.filter(F.col(key_col) == F.lit(key)).select(F.col(value_col))


def align_groups(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Two aggregates on the same group key, full outer."""
    return a.join(b, key, "full_outer")


def rename_metrics(df: DataFrame) -> DataFrame:
    """Normalise column names: spaces -> underscores, dots dropped, lower case."""
    return df.withColumnsRenamed({c: c.strip().replace(" ", "_").replace(".", "").lower() for c in df.columns})


def recorded_metrics(spark, values: Mapping[str, float]) -> DataFrame:
    return spark.createDataFrame([(k, float(v)) for k, v in values.items()], "metric string, value double")
