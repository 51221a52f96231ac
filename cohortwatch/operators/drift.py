"""Two-sample drift per column and the dataset verdict.

Plan for c columns and any number of current groups (scenarios):

1. Both samples are unpivoted once to (group, column, value); nulls, NaN and
   infinities are dropped (as the per-column tests do).
2. Value counts per (group, column, value) -- one aggregation, combined
   map-side. The reference counts are attached to every current group by an
   equi-join on the column name (reference rows x groups, never all pairs of
   rows).
3. Numeric columns: CDFs of both sides on the union grid by an ordered scan
   (bucketed, see ``scan.ordered_scan``) -> K-S D and Wasserstein-1.
   Categorical (and numeric with <= 5 values): shares -> Jensen-Shannon,
   chi-square goodness of fit, two-proportion z.
4. Test selection per column by kind, reference size and distinct count;
   p-values by closed-form expressions on one row per column.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortwatch.functions.stats import chi2_sf, ks_p_value, normal_two_sided_p
from cohortwatch.operators.scan import ordered_scan
from cohortwatch.operators.split import broadcast_if_small
from cohortwatch.session import cut_lineage

# ---------------------------------------------------------------------------
# Fixed values (default test regime of the drift report).
SMALL_REFERENCE_ROWS = 1000      # reference at or below -> p-value tests
FEW_VALUES = 5                   # numeric with at most this many values -> categorical tests
BINARY_VALUES = 2                # at most this many values -> z test
P_VALUE_THRESHOLD = 0.05         # drift when p < threshold
DISTANCE_THRESHOLD = 0.1         # drift when distance >= threshold
DATASET_DRIFT_SHARE = 0.5        # dataset drift when share of drifted columns >= this
STD_FLOOR = 0.001                # Wasserstein norm floor
# ---------------------------------------------------------------------------

G = "__g"


def long_form(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str],
              group: str | None = None) -> DataFrame:
    """(g, column, kind, vnum, vtxt) for every non-missing cell."""
    g = F.col(group).cast("string") if group else F.lit("")
    # one struct per cell, then Spark's unpivot (an Expand, inside whole-stage codegen)
    cells = [F.struct(F.lit("num").alias("kind"), (F.col(c).cast("double") + 0.0).alias("vnum"),
                      F.lit(None).cast("string").alias("vtxt")).alias(f"__c{i}") for i, c in enumerate(numeric)]
    cells += [F.struct(F.lit("cat").alias("kind"), F.lit(None).cast("double").alias("vnum"),
                       F.col(c).cast("string").alias("vtxt")).alias(f"__c{len(numeric) + i}")
              for i, c in enumerate(categorical)]
    names = list(numeric) + list(categorical)
    wide = df.select(g.alias(G), *cells)
    long = wide.unpivot([G], [F.col(f"__c{i}").alias(c) for i, c in enumerate(names)], "column", "__v")
    long = long.select(G, "column", "__v.kind", "__v.vnum", "__v.vtxt")
    ok_num = F.col("vnum").isNotNull() & ~F.isnan("vnum") & (F.abs("vnum") != float("inf"))
    return long.filter(F.when(F.col("kind") == "num", ok_num).otherwise(F.col("vtxt").isNotNull()))


def expected_columns(current: DataFrame, numeric: Sequence[str], categorical: Sequence[str],
                     group: str | None = None) -> DataFrame:
    """(g, column, kind): every listed column for every group of the current sample, with or without values."""
    if group:
        groups = current.select(F.col(group).cast("string").alias(G)).where(F.col(G).isNotNull()).distinct()
    else:
        groups = current.sparkSession.range(1).select(F.lit("").alias(G))
    listed = [F.struct(F.lit(c).alias("column"), F.lit(kind).alias("kind"))
              for kind, names in (("num", numeric), ("cat", categorical)) for c in names]
    return groups.select(G, F.inline(F.array(*listed)))


def value_grid(reference: DataFrame, current: DataFrame, numeric: Sequence[str], categorical: Sequence[str],
               group: str | None = None) -> DataFrame:
    """(g, column, kind, vnum, vtxt, n_r, n_c) over the union of values per (g, column)."""
    keys = ["column", "kind", "vnum", "vtxt"]
    if group is None:
        # one current sample: tag both sides and count them in a single aggregation (one shuffle)
        both = (long_form(reference, numeric, categorical).withColumn("__r", F.lit(1))
                .unionByName(long_form(current, numeric, categorical).withColumn("__r", F.lit(0))))
        return both.groupBy(G, *keys).agg(F.sum("__r").cast("long").alias("n_r"),
                                          F.sum(1 - F.col("__r")).cast("long").alias("n_c"))
    ref = long_form(reference, numeric, categorical).groupBy(*keys).agg(F.count(F.lit(1)).alias("n_r"))
    cur = long_form(current, numeric, categorical, group).groupBy(G, *keys).agg(F.count(F.lit(1)).alias("n_c"))
    groups = expected_columns(current, numeric, categorical, group).select(G, "column")
    ref_g = ref.join(groups, "column", "inner")  # reference counts attached to every group
    both = (ref_g.select(G, *keys, "n_r", F.lit(0).cast("long").alias("n_c"))
            .unionByName(cur.select(G, *keys, F.lit(0).cast("long").alias("n_r"), "n_c")))
    return both.groupBy(G, *keys).agg(F.sum("n_r").alias("n_r"), F.sum("n_c").alias("n_c"))


def _column_totals(grid: DataFrame, expected: DataFrame) -> DataFrame:
    """Sizes per (g, column); a column without any value keeps its row, with zeros."""
    found = grid.groupBy(G, "column", "kind").agg(
        F.sum("n_r").alias("n_ref"), F.sum("n_c").alias("n_cur"), F.count(F.lit(1)).alias("n_values"),
        F.min(F.when(F.col("n_r") > 0, F.col("vnum"))).alias("least"))
    return expected.join(found, [G, "column", "kind"], "left").fillna(0, ["n_ref", "n_cur", "n_values"])


def numeric_distances(grid: DataFrame, totals: DataFrame) -> DataFrame:
    """(g, column, ks_d, w1, w1_norm) for numeric columns.

    ``totals`` is the per-(g, column) table, already sized for the join.
    """
    num = grid.filter(F.col("kind") == "num").select(G, "column", "vnum", "n_r", "n_c")
    sc = ordered_scan(num, [G, "column"], "vnum", ["n_r", "n_c"], stored_input=True)
    sc = sc.join(totals.select(G, "column", "n_ref", "n_cur", "least"), [G, "column"])
    # the spread of the reference is summed up from its least value, which keeps the digits
    dev = F.col("vnum") - F.col("least")
    # try_divide: a column with no values on one side gives null statistics, not a failed job
    diff = F.abs(F.try_divide(F.col("cum_n_r"), F.col("n_ref")) - F.try_divide(F.col("cum_n_c"), F.col("n_cur")))
    per = sc.groupBy(G, "column").agg(
        F.max(diff).alias("ks_d"),
        F.sum(diff * F.coalesce(F.col("next_value") - F.col("vnum"), F.lit(0.0))).alias("w1"),
        F.try_divide(F.sum(F.col("n_r") * dev), F.max("n_ref")).alias("m1"), F.try_divide(F.sum(F.col("n_r") * dev * dev), F.max("n_ref")).alias("m2"))
    std_ref = F.sqrt(F.greatest(F.col("m2") - F.col("m1") * F.col("m1"), F.lit(0.0)))
    return per.select(G, "column", "ks_d", "w1", (F.col("w1") / F.greatest(std_ref, F.lit(STD_FLOOR))).alias("w1_norm"))


def categorical_stats(grid: DataFrame, totals: DataFrame) -> DataFrame:
    """(g, column, js, chi2, chi2_df, z) from value shares."""
    g = grid.join(totals.select(G, "column", "n_ref", "n_cur"), [G, "column"])
    p = F.try_divide(F.col("n_r"), F.col("n_ref"))
    q = F.try_divide(F.col("n_c"), F.col("n_cur"))
    m = (p + q) / 2.0
    kl = F.when(p > 0, p * F.log(p / m)).otherwise(0.0) + F.when(q > 0, q * F.log(q / m)).otherwise(0.0)
    expected = F.col("n_r") * F.try_divide(F.col("n_cur"), F.col("n_ref"))
    chi_term = F.when(expected > 0, (F.col("n_c") - expected) * (F.col("n_c") - expected) / expected).otherwise(
        F.lit(float("inf")))
    key = F.struct(F.col("vnum"), F.col("vtxt"))
    per = g.groupBy(G, "column").agg(
        F.sqrt(F.greatest(F.sum(kl) / 2.0, F.lit(0.0))).alias("js"),
        F.sum(chi_term).alias("chi2"), (F.count(F.lit(1)) - 1).alias("chi2_df"),
        F.min_by(F.struct("n_r", "n_c", "n_ref", "n_cur"), key).alias("__k"),
        F.count_if(F.col("n_r") > 0).alias("__ur"), F.count_if(F.col("n_c") > 0).alias("__uc"),
        F.count(F.lit(1)).alias("__u"))
    p1 = F.try_divide(F.col("__k.n_r"), F.col("__k.n_ref"))
    p2 = F.try_divide(F.col("__k.n_c"), F.col("__k.n_cur"))
    pooled = F.try_divide(F.col("__k.n_r") + F.col("__k.n_c"), F.col("__k.n_ref") + F.col("__k.n_cur"))
    z = F.try_divide(p1 - p2, F.sqrt(pooled * (1 - pooled) * (F.try_divide(F.lit(1.0), F.col("__k.n_ref"))
                                                             + F.try_divide(F.lit(1.0), F.col("__k.n_cur")))))
    same_single = (F.col("__u") == 1) & (F.col("__ur") == 1) & (F.col("__uc") == 1)
    return per.select(G, "column", "js", "chi2", "chi2_df",
                      F.when(same_single, F.lit(0.0)).otherwise(z).alias("z"),
                      same_single.alias("__same"))


def select_test(kind, n_ref, n_values, regime: str = "auto"):
    """Default test per column (D06); ``regime`` "pvalue" or "distance" overrides the choice by reference size."""
    if regime not in ("auto", "pvalue", "distance"):
        raise ValueError(f"regime {regime!r}: auto, pvalue or distance")
    small = {"auto": n_ref <= SMALL_REFERENCE_ROWS, "pvalue": F.lit(True), "distance": F.lit(False)}[regime]
    numeric_many = (kind == "num") & (n_values > FEW_VALUES)
    return (F.when(small, F.when(numeric_many, "ks").when(n_values > BINARY_VALUES, "chisquare").otherwise("z"))
            .otherwise(F.when(numeric_many, "wasserstein").otherwise("jensenshannon")))


def drift_table(reference: DataFrame, current: DataFrame, numeric: Sequence[str], categorical: Sequence[str],
                group: str | None = None, regime: str = "auto") -> DataFrame:
    """Per (group, column): kind, sizes, test, statistic, p_value, score, drifted.

    Every listed column has a row in every group. A column that has lost all its values
    has drifted (its statistics are null); one without reference values cannot be judged
    and has not. ``test``,
    ``statistic`` and ``p_value`` follow the chosen test; ``ks_p`` (numeric columns),
    ``chi2_p`` (categorical columns, and numeric ones of few values) and ``z_p`` (two
    values at most) are there at any size.
    """
    # The grid (value counts) is the one heavy pass over both samples; it is written once to
    # the shared checkpoint folder so every statistic below reads it instead of recomputing.
    grid = cut_lineage(value_grid(reference, current, numeric, categorical, group))
    # one row per (group, column): counted once, broadcast when small
    totals = broadcast_if_small(_column_totals(grid, expected_columns(current, numeric, categorical, group)), materialize=bool(group))
    cat = categorical_stats(grid, totals)
    out = totals.join(cat, [G, "column"], "left")
    if numeric:
        out = out.join(numeric_distances(grid, totals), [G, "column"], "left")
    else:
        out = out.withColumns({"ks_d": F.lit(None).cast("double"), "w1": F.lit(None).cast("double"),
                               "w1_norm": F.lit(None).cast("double")})
    test = select_test(F.col("kind"), F.col("n_ref"), F.col("n_values"), regime)
    out = out.withColumn("test", test)
    few = (F.col("kind") == "cat") | (F.col("n_values") <= FEW_VALUES)
    out = out.withColumns({
        "ks_p": F.when((F.col("kind") == "num") & F.col("ks_d").isNotNull(), ks_p_value(F.col("ks_d"), F.col("n_ref"), F.col("n_cur"))),
        "chi2_p": F.when(few, chi2_sf(F.col("chi2"), F.col("chi2_df"))),
        "z_p": F.when(F.col("n_values") <= BINARY_VALUES, F.when(F.col("__same"), F.lit(1.0)).otherwise(normal_two_sided_p(F.col("z"))))})
    name = F.col("test")
    statistic = (F.when(name == "ks", F.col("ks_d")).when(name == "chisquare", F.col("chi2"))
                 .when(name == "z", F.col("z")).when(name == "wasserstein", F.col("w1_norm")).otherwise(F.col("js")))
    p_value = F.when(name == "ks", F.col("ks_p")).when(name == "chisquare", F.col("chi2_p")).when(name == "z", F.col("z_p"))
    out = out.withColumns({"statistic": statistic, "p_value": p_value})
    score = F.coalesce(F.col("p_value"), F.col("statistic"))
    by_test = F.when(name.isin("ks", "chisquare", "z"), F.col("p_value") < P_VALUE_THRESHOLD).otherwise(
        F.col("statistic") >= DISTANCE_THRESHOLD)
    emptied = (F.col("n_ref") > 0) & (F.col("n_cur") == 0)
    out = out.withColumns({"score": score, "drifted": emptied | F.coalesce(by_test, F.lit(False))})
    cols = ([F.col(G).alias(group)] if group else []) + [
        "column", "kind", "n_ref", "n_cur", "n_values", "test", "statistic", "p_value", "score", "drifted",
        "ks_d", "w1_norm", "js", "chi2", "chi2_df", "z", "ks_p", "chi2_p", "z_p"]
    return out.select(*cols)


def dataset_verdict(table: DataFrame, group: str | None = None, share: float = DATASET_DRIFT_SHARE) -> DataFrame:
    """(group?, n_columns, n_drifted, drifted_columns, drift_share, dataset_drift).

    The drifted-column list holds at most one name per column, so it is small.
    """
    keys = [group] if group else []
    agg = table.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_columns"), F.count_if("drifted").alias("n_drifted"),
        F.array_join(F.array_sort(F.collect_list(F.when(F.col("drifted"), F.col("column")))), ", ")
        .alias("drifted_columns"))
    return agg.withColumn("drift_share", F.try_divide(F.col("n_drifted"), F.col("n_columns"))).withColumn(
        "dataset_drift", F.col("drift_share") >= F.lit(share))


def drifted_columns(table: DataFrame, group: str | None = None) -> DataFrame:
    """Comma list of drifted columns per group, ordered by name."""
    keys = [group] if group else []
    return table.groupBy(*keys).agg(F.array_join(F.array_sort(F.collect_list(
        F.when(F.col("drifted"), F.col("column")))), ", ").alias("drifted_columns"))
