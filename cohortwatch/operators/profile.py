"""Profiling operators.

Every profile is one aggregation pass (partial + final) followed by an
unpivot, so the work per column is a handful of aggregate buffers and never a
per-column job. Running sums go through ``scan.ordered_scan``.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortwatch.functions.values import clip
from cohortwatch.operators.scan import ordered_scan

# Rows over the rank error of the sketch that brackets a quantile.
QUANTILE_ACCURACY = 10_000


def value_counts(df: DataFrame, column: str, dropna: bool = True) -> DataFrame:
    """(value, n) descending by n, ties by value."""
    src = df.filter(F.col(column).isNotNull()) if dropna else df
    return (src.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
               .orderBy(F.desc("n"), F.asc_nulls_last(column)))


def value_shares(df: DataFrame, column: str) -> DataFrame:
    """(value, n, share) over non-null values."""
    nn = df.filter(F.col(column).isNotNull())
    total = nn.agg(F.count(F.lit(1))).scalar()
    return nn.groupBy(column).agg(F.count(F.lit(1)).alias("n")).withColumn("share", F.col("n") / total)


def missing_profile(df: DataFrame, columns: Sequence[str] | None = None, nonzero_only: bool = False) -> DataFrame:
    """(column, n_missing, pct_missing) from one aggregate, descending."""
    cols = list(columns) if columns is not None else df.columns
    wide = df.agg(F.count(F.lit(1)).alias("__n"),
                  *[F.count_if(F.col(c).isNull()).alias(f"m_{i}") for i, c in enumerate(cols)])
    stacked = wide.select(
        F.col("__n"),
        F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"m_{i}").alias("n_missing"))
                           for i, c in enumerate(cols)])))
    out = stacked.select("column", "n_missing",
                         F.try_divide(F.col("n_missing") * 100.0, F.col("__n")).alias("pct_missing"))
    if nonzero_only:
        out = out.filter(F.col("n_missing") > 0)
    return out.orderBy(F.desc("n_missing"), "column")


def exact_quantiles(df: DataFrame, columns: Sequence[str], probs: Sequence[float]) -> DataFrame:
    """(column, q0, q1, ...) exact quantiles with linear interpolation between order statistics.

    Multi-selection in two passes, all columns at once. A mergeable sketch, whose ranks are off by
    1 / QUANTILE_ACCURACY of the rows at most, gives each quantile a bracket of values that holds
    the order statistics asked for (a column of few values: the whole of it). Then the values
    inside the brackets are counted, combined map-side, and those below them as single numbers, so
    the count of a value is exact and few rows are exchanged. Columns without values have nulls.
    """
    eps = 2.0 / QUANTILE_ACCURACY
    xs = [F.nanvl(F.col(c).cast("double") + 0.0, F.lit(None).cast("double")) for c in columns]
    wide = df.select(*[x.alias(f"__v{i}") for i, x in enumerate(xs)])
    shares = [min(1.0, max(0.0, p + side)) for p in probs for side in (-eps, eps)]
    first = wide.agg(*[F.struct(F.count(f"__v{i}").alias("n"), F.percentile_approx(f"__v{i}", shares, QUANTILE_ACCURACY).alias("cuts")).alias(f"s{i}")
                       for i in range(len(columns))]).first()
    brackets = []  # a few numbers per column and quantile
    for i, c in enumerate(columns):
        n, cuts = first[f"s{i}"]["n"], first[f"s{i}"]["cuts"]
        for j in range(len(probs)) if n else ():
            low, high = (cuts[2 * j], cuts[2 * j + 1]) if n > QUANTILE_ACCURACY else (float("-inf"), float("inf"))
            brackets.append((i, c, j, n, low, high))
    spark = df.sparkSession
    if not brackets:
        return spark.createDataFrame([(c,) for c in columns], "column string").select("column", *[F.lit(None).cast("double").alias(f"q{j}") for j in range(len(probs))])
    below = wide.agg(*[F.count_if(F.col(f"__v{i}") < low).alias(f"b{i}_{j}") for i, _, j, _, low, _ in brackets])
    below = below.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), F.lit(j).alias("j"), F.lit(n).cast("long").alias("n"), F.lit(low).alias("low"), F.lit(high).alias("high"),
                 F.col(f"b{i}_{j}").alias("below")) for i, c, j, n, low, high in brackets])))
    inside = []
    for i, c in enumerate(columns):
        held = [F.col(f"__v{i}").between(low, high) for k, _, _, _, low, high in brackets if k == i]
        inside.append(F.when(reduce(or_, held, F.lit(False)), F.col(f"__v{i}")).alias(f"__v{i}"))
    long = wide.select(*inside).unpivot([], [F.col(f"__v{i}").alias(c) for i, c in enumerate(columns)], "column", "value")
    counts = long.where(F.col("value").isNotNull()).groupBy("column", "value").agg(F.count(F.lit(1)).alias("times"))
    placed = counts.join(F.broadcast(below), "column").where(F.col("value").between(F.col("low"), F.col("high")))
    # distinct values of a bracket: those strictly inside it are within the sketch's error
    most = max(max(QUANTILE_ACCURACY, 8 * n // QUANTILE_ACCURACY + 2) for _, _, _, n, _, _ in brackets)
    ranked = ordered_scan(placed, ["column", "j"], "value", ["times"], most=most)
    share = F.element_at(F.array(*[F.lit(float(p)) for p in probs]), F.col("j") + 1)
    ranked = ranked.withColumns({"upto": F.col("below") + F.col("cum_times"), "h": share * (F.col("n") - 1)})
    least = ranked.groupBy("column", "j").agg(
        F.min(F.when(F.col("upto") >= F.floor("h") + 1, F.col("value"))).alias("lo"),
        F.min(F.when(F.col("upto") >= F.ceil("h") + 1, F.col("value"))).alias("hi"), F.first(F.col("h") - F.floor("h")).alias("part"))
    value = F.col("lo") + F.col("part") * (F.col("hi") - F.col("lo"))
    found = least.groupBy("column").agg(*[F.max(F.when(F.col("j") == j, value)).alias(f"q{j}") for j in range(len(probs))])
    return spark.createDataFrame([(c,) for c in columns], "column string").join(F.broadcast(found), "column", "left")


def describe(df: DataFrame, columns: Sequence[str], exact: bool = True,
             decimal_scale: int | None = None) -> DataFrame:
    """(column, count, mean, std, min, q25, q50, q75, max) per column.

    Sample std (ddof 1); quartiles by linear interpolation, exact
    (``exact_quantiles``) or, with ``exact=False``, from the sketch-based ``percentile_approx``. With ``decimal_scale`` the mean is an
    exact decimal sum divided by the count, so it does not depend on the order
    in which partitions are summed.
    """
    aggs = []
    for i, c in enumerate(columns):
        x = F.col(c).cast("double")
        mean = (F.try_divide(F.sum(F.col(c).cast(f"decimal(30,{decimal_scale})")).cast("double"), F.count(x))
                if decimal_scale is not None else F.avg(x))
        parts = [F.lit(c).alias("column"), F.count(x).alias("count"), mean.alias("mean"),
                 F.stddev_samp(x).alias("std"), F.min(x).alias("min"), F.max(x).alias("max")]
        if not exact:
            parts += [F.percentile_approx(x, p, 10000).cast("double").alias(f"q{j}")
                      for j, p in enumerate((0.25, 0.5, 0.75))]
        aggs.append(F.struct(*parts).alias(f"s{i}"))
    stats = df.agg(*aggs).select(F.inline(F.array(*[F.col(f"s{i}") for i in range(len(columns))])))
    if exact:
        stats = stats.join(exact_quantiles(df, columns, (0.25, 0.5, 0.75)), "column", "left")
    return stats.select("column", "count", "mean", "std", "min", F.col("q0").alias("q25"),
                        F.col("q1").alias("q50"), F.col("q2").alias("q75"), "max")


def corr_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson correlation of every ordered pair, long form.

    One pass over the rows where both columns have values, pair by pair: each unordered pair is one
    buffer of co-moments, merged map-side, and both of its orders are read from it.
    """
    columns = list(columns)
    pairs = {(i, j): f"c{i}_{j}" for i in range(len(columns)) for j in range(i, len(columns))}
    wide = df.agg(*[F.corr(F.col(columns[i]).cast("double"), F.col(columns[j]).cast("double")).alias(name) for (i, j), name in pairs.items()])
    return wide.select(F.inline(F.array(*[
        F.struct(F.lit(a).alias("col_a"), F.lit(b).alias("col_b"), F.col(pairs[min(i, j), max(i, j)]).alias("corr"))
        for i, a in enumerate(columns) for j, b in enumerate(columns)])))


def target_corr(df: DataFrame, columns: Sequence[str], target: str) -> DataFrame:
    """Correlation of each column with the target, by absolute value desc."""
    cols = [c for c in columns if c != target]
    wide = df.agg(*[F.corr(F.col(c).cast("double"), F.col(target).cast("double")).alias(f"c{i}")
                    for i, c in enumerate(cols)])
    out = wide.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(f"c{i}").alias("corr")) for i, c in enumerate(cols)])))
    return out.orderBy(F.desc(F.abs("corr")), "column")


def rate_by_group(df: DataFrame, key: str | Sequence[str], target: str) -> DataFrame:
    """(key, n, rate) with rate = mean of a 0/1 target (G07, G09 with a predicate target)."""
    keys = [key] if isinstance(key, str) else list(key)
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.avg(F.col(target).cast("double")).alias("rate"))


def rate_all_groups(spark: SparkSession, df: DataFrame, key: str, target: str, low: int, high: int) -> DataFrame:
    """Rate for every group value in [low, high]; absent group -> n 0, rate null."""
    dim = spark.range(low, high + 1).select(F.col("id").alias(key))
    rates = rate_by_group(df, key, target)
    return (dim.join(rates, key, "left")
               .select(key, F.coalesce("n", F.lit(0)).alias("n"), "rate"))


def rate_predicate(df: DataFrame, key: str, predicate) -> DataFrame:
    """(key, n, rate) where rate = share of rows meeting the predicate."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n"),
                               F.avg(F.when(predicate, 1.0).otherwise(0.0)).alias("rate"))


def rate_capped(df: DataFrame, column: str, target: str, upper) -> DataFrame:
    """Rate by value clipped at ``upper``."""
    return rate_by_group(df.withColumn(column, clip(column, high=upper)), column, target)


def positive_rate(df: DataFrame, target: str) -> DataFrame:
    """(n, positive_rate)."""
    return df.agg(F.count(F.lit(1)).alias("n"), F.avg(F.col(target).cast("double")).alias("positive_rate"))


def histogram(spark: SparkSession, df: DataFrame, column: str, bins: int = 30) -> DataFrame:
    """Equal-width histogram over [min, max]; last bin closed; empty bins kept."""
    x = F.col(column).cast("double")
    nn = df.filter(x.isNotNull()).select(x.alias("x"))
    lo = nn.agg(F.min("x")).scalar()
    hi = nn.agg(F.max("x")).scalar()
    width = (hi - lo) / F.lit(float(bins))
    b = F.when(hi == lo, F.lit(0)).otherwise(
        F.least(F.floor((F.col("x") - lo) / width), F.lit(bins - 1))).cast("long")
    counts = nn.groupBy(b.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    dim = spark.range(bins).select(F.col("id").alias("bin"))
    return (dim.join(counts, "bin", "left")
               .select("bin",
                       (lo + F.col("bin") * width).alias("bin_low"),
                       (lo + (F.col("bin") + 1) * width).alias("bin_high"),
                       F.coalesce("n", F.lit(0)).alias("n")))


def _value_counts_long(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, value, n) over non-null values: one unpivot (Expand) and one partial+final count."""
    wide = df.select(*[F.col(c).cast("string").alias(f"__v{i}") for i, c in enumerate(columns)])
    long = wide.unpivot([], [F.col(f"__v{i}").alias(c) for i, c in enumerate(columns)], "column", "value")
    return long.filter(F.col("value").isNotNull()).groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))


def distinct_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, n_distinct) over non-null values (G25), from the (column, value) count grid.

    Several exact distinct counts in one aggregate would copy every row once
    per column; the grid is combined map-side instead.
    """
    grid = _value_counts_long(df, columns)
    return grid.groupBy("column").agg(F.count(F.lit(1)).alias("n_distinct"))


def target_balance(df: DataFrame, target: str) -> DataFrame:
    """(class, n, pct)."""
    total = df.agg(F.count(F.lit(1))).scalar()
    return (df.groupBy(F.col(target).alias("class")).agg(F.count(F.lit(1)).alias("n"))
              .withColumn("pct", F.col("n") * 100.0 / total))


def cumulative_share(df: DataFrame, column: str) -> DataFrame:
    """Shares descending with their running sum.

    The running count is an ordered scan by (count descending, value), so many distinct
    values are dealt over ranges.
    """
    shares = value_shares(df, column).withColumn("__order", F.struct(F.negative("n").alias("less"), F.col(column).alias("value")))
    total = df.agg(F.count(column)).scalar()
    scanned = ordered_scan(shares, [], "__order", ["n"], cum_prefix="__cum_", next_col="__next")
    return scanned.withColumn("cum_share", F.col("__cum_n") / total).drop("__order", "__cum_n", "__next")


def top_k_groups(df: DataFrame, column: str, k: int) -> DataFrame:
    """The k most frequent values (L02); ties broken by value."""
    return value_counts(df, column).limit(k)


def quality_profile(df: DataFrame, columns: Sequence[str], numeric: Sequence[str] = ()) -> DataFrame:
    """Per column: counts, missing, distinct, text min and max, most common value, quartiles, strongest correlation.

    One aggregate for counts and text min/max, one (column, value) count grid for the distinct
    count and the most common value (highest count, ties by smallest text), and for the
    ``numeric`` columns exact quartiles and, from one pass of co-moments, the other numeric column of
    largest absolute correlation (ties by name); null for columns that are not numeric.
    """
    as_text = [F.col(c).cast("string") for c in columns]
    wide = df.agg(F.count(F.lit(1)).alias("__n"), *[
        F.struct(F.lit(c).alias("column"),
                 F.count(F.col(c)).alias("n_present"),
                 F.count_if(F.col(c).isNull()).alias("n_missing"),
                 F.min(t).alias("min_text"), F.max(t).alias("max_text")).alias(f"s{i}")
        for i, (c, t) in enumerate(zip(columns, as_text))])
    stats = wide.select("__n", F.inline(F.array(*[F.col(f"s{i}") for i in range(len(columns))])))
    counts = _value_counts_long(df, columns)
    top = counts.groupBy("column").agg(
        F.count(F.lit(1)).alias("n_distinct"),
        F.min(F.struct(F.negative("n").alias("neg_n"), F.col("value"))).alias("__t"))
    top = top.select("column", "n_distinct", F.col("__t.value").alias("most_common"),
                     F.negative("__t.neg_n").alias("most_common_n"))
    out = stats.join(top, "column", "left")
    if numeric:
        quartiles = exact_quantiles(df, numeric, (0.25, 0.5, 0.75)).select("column", F.col("q0").alias("q25"), F.col("q1").alias("q50"), F.col("q2").alias("q75"))
        pairs = corr_matrix(df, numeric).where("col_a <> col_b and corr is not null")
        # compared at 12 digits, so that equal correlations tie whatever the order of summation
        strongest = pairs.groupBy(F.col("col_a").alias("column")).agg(
            F.min(F.struct((-F.round(F.abs("corr"), 12)).alias("less"), F.col("col_b").alias("with"), "corr")).alias("__c"))
        out = out.join(quartiles, "column", "left").join(strongest, "column", "left")
    else:
        out = out.withColumns({"__c": F.lit(None).cast("struct<less:double,with:string,corr:double>"),
                               **{q: F.lit(None).cast("double") for q in ("q25", "q50", "q75")}})
    return out.select("column", F.col("__n").alias("n_rows"), "n_present", "n_missing",
                      F.try_divide(F.col("n_missing") * 100.0, F.col("__n")).alias("pct_missing"),
                      F.coalesce("n_distinct", F.lit(0)).alias("n_distinct"), "min_text", "max_text",
                      "most_common", "most_common_n", "q25", "q50", "q75",
                      F.col("__c.with").alias("corr_with"), F.col("__c.corr").alias("corr"))


def null_assert(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, n_null, ok) check table; ok when the column has no nulls."""
    return missing_profile(df, columns).select("column", F.col("n_missing").alias("n_null"),
                                               (F.col("n_missing") == 0).alias("ok"))


def mode_per_column(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, mode) most frequent non-null value, ties -> smallest."""
    long = df.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns])))
    counts = long.filter(F.col("value").isNotNull()).groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    best = counts.groupBy("column").agg(F.min(F.struct(F.negative("n").alias("neg_n"), F.col("value"))).alias("t"))
    return best.select("column", F.col("t.value").alias("mode"))
