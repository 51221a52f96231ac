"""Feature operators.

Rare-category bucketing joins the rows to a keep list. That list holds only
categories whose share is at least ``min_share_pct`` percent, so it has at most
``100 / min_share_pct`` rows whatever the data size: a proven bound, which is
what makes the broadcast safe.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortwatch.functions.codes import (AGE_BANDS, flag_equal, flag_not_equal,
                                         group_codes, ordinal_lookup, py_float)
from cohortwatch.session import cut_lineage


def add_code_groups(df: DataFrame, code: str, out: str, **kw) -> DataFrame:
    """F01 as a column: the number is parsed once into a helper column, then grouped."""
    tmp = f"__num_{out}"
    return (df.withColumn(tmp, py_float(F.col(code).cast("string")))
              .withColumn(out, group_codes(code, numeric=F.col(tmp), **kw)).drop(tmp))


def category_shares(df: DataFrame, column: str) -> DataFrame:
    """(value, count, share_pct) over non-null values (G02, N5); the counts are written, so ``df`` is computed once."""
    counts = cut_lineage(df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n")))
    return counts.withColumn("share_pct", F.col("n") * 100.0 / counts.agg(F.sum("n")).scalar())


def keep_list(df: DataFrame, column: str, min_share_pct: float) -> DataFrame:
    """Categories at or above the share threshold; at most 100/min_share_pct rows."""
    if min_share_pct <= 0:
        raise ValueError("min_share_pct must be positive to bound the keep list")
    return (category_shares(df, column)
            .filter(F.col("share_pct") >= F.lit(float(min_share_pct)))
            .select(F.col(column).alias("__keep")))


def rare_bucket(df: DataFrame, column: str, out: str, min_share_pct: float,
                other: str = "Other", share_source: DataFrame | None = None) -> DataFrame:
    """``out`` = value if its share >= threshold else ``other``; null -> other."""
    keep = keep_list(share_source if share_source is not None else df, column, min_share_pct)
    joined = df.join(F.broadcast(keep), F.col(column).eqNullSafe(F.col("__keep")), "left")
    return (joined.withColumn(out, F.when(F.col("__keep").isNotNull(), F.col(column)).otherwise(F.lit(other)))
                  .drop("__keep"))


def feature_pipeline(clean: DataFrame, *, target_source: str, target_negative: str, target: str,
                     code_column: str, code_out: str, rare_column: str, rare_out: str,
                     min_share_pct: float, flag_column: str, flag_value: str, flag_out: str,
                     band_column: str, band_out: str, bands=AGE_BANDS) -> DataFrame:
    """Target flag, code groups, rare bucketing, equality flag, ordinal band."""
    df = clean.withColumn(target, flag_not_equal(target_source, target_negative))
    df = add_code_groups(df, code_column, code_out)
    df = rare_bucket(df, rare_column, rare_out, min_share_pct)
    return df.withColumns({
        flag_out: flag_equal(flag_column, flag_value),
        band_out: ordinal_lookup(band_column, bands),
    })
