"""Metric time-series operators.

Samples are rows (ts, name, labels/series key, value). A range window over a series ("the last
minute") is a window frame while every series has at most ``FRAME_ROWS`` samples, which bounds
its partition and what a frame may hold. Where a series is larger, what the window holds is a difference of two running sums:
up to the sample, and up to the first sample of the window. Both are kept per range of the
series' own rows and the second one is looked up in the range where the window starts, so a
burst, however short, is spread over many tasks and no row is copied into neighbouring windows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cohortwatch.operators import scan
from cohortwatch.operators.scan import ordered_scan
from cohortwatch.operators.split import broadcast_if_small
from cohortwatch.session import cut_lineage

# Samples of a series up to which a range window is a frame; a frame is summed up anew for each row.
FRAME_ROWS = 25_000


def _us(ts: str):
    return F.unix_micros(F.col(ts).cast("timestamp"))


def _largest(df: DataFrame, series: Sequence[str]) -> int:
    return df.groupBy(*series).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0


def _held(rows: DataFrame, series: Sequence[str], back: int, value: str | None) -> DataFrame:
    """``rows`` (with __t) with ``__held``: the steps from the window's first sample on up to those of time __t.

    The step into a sample is the increase of ``value`` since the one before it, or 1 without a
    ``value``; the first sample of a window is that of least (time, value) among those of the last
    ``back`` microseconds. Rows are dealt once by ranges of (series, time) and written with the
    sums inside their range. A sample asks for the first time of its window in the range that
    holds it, known from the ranges' last times, so a row is dealt once more, whatever the window holds.
    """
    many = -(-rows.count() // scan.RANGE_ROWS)
    names = rows.columns
    ordered = F.struct("__t", F.col(value).alias("v")) if value else F.struct("__t")
    dealt = rows.withColumn("__o", ordered).repartitionByRange(many, *series, "__t").withColumn("__b", F.spark_partition_id())
    inside = Window.partitionBy(*series, "__b").orderBy("__t", "__o")
    dealt = dealt.withColumn("__step", F.coalesce(_step(F.lag(value).over(inside), F.col(value)), F.lit(0.0)) if value else F.lit(1).cast("long"))
    dealt = dealt.withColumn("__sum", F.sum("__step").over(inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    instant = Window.partitionBy(*series, "__b", "__t").orderBy("__o")
    dealt = dealt.withColumns({"__first": F.first("__sum").over(instant.rowsBetween(Window.unboundedPreceding, Window.currentRow)),
                               "__rank": F.row_number().over(instant),
                               "__upto": F.last("__sum").over(instant.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))})
    # the ranges come from a sample: written, so that all that follows sees the same ones
    dealt = cut_lineage(dealt.drop("__step", "__sum"))

    # one row per range: its sums, what goes before it, and the times that it is asked for
    ranges = dealt.groupBy(*series, "__b").agg(F.max("__t").alias("__hi"), F.min("__o").alias("__o0"), F.max("__o").alias("__o1"),
                                               F.max_by("__upto", F.struct(F.col("__t"))).alias("__total"))
    along = Window.partitionBy(*series).orderBy("__b")
    ranges = ranges.withColumn("__into", F.coalesce(_step(F.lag("__o1.v").over(along), F.col("__o0.v")), F.lit(0.0)) if value else F.lit(0).cast("long"))
    before = F.coalesce(F.sum("__total").over(along.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ranges = ranges.withColumns({"__off": before + F.sum("__into").over(along), "__lo": F.lag("__hi").over(along), "__t0": F.col("__o0.__t")})
    ranges = cut_lineage(ranges.select(*series, "__b", "__hi", "__lo", "__t0", "__off"))
    mine, asked = ranges.alias("m"), ranges.alias("a")
    same = [F.col(f"m.{c}").eqNullSafe(F.col(f"a.{c}")) for c in series]
    # windows of a range start from m.__t0 - back to m.__hi - back; those of rows without a time in the range itself
    meets = (F.col("a.__b") == F.col("m.__b")) | ((F.col("a.__hi") >= F.col("m.__t0") - back) & (F.col("a.__lo").isNull() | (F.col("a.__lo") < F.col("m.__hi") - back)))
    pairs = mine.join(asked, [*same, F.col("a.__b") <= F.col("m.__b"), meets]).select(
        *[F.col(f"m.{c}").alias(f"__s{i}") for i, c in enumerate(series)], F.col("m.__b").alias("__mb"), F.col("a.__b").alias("__ab"),
        F.col("a.__hi").alias("__ahi"), F.col("a.__lo").alias("__alo"),
        F.when(F.col("m.__b") == F.col("a.__b"), F.lit(0)).otherwise(F.col("m.__off") - F.col("a.__off")).alias("__gap"))
    to = [F.col("__b") == F.col("__mb")] + [F.col(c).eqNullSafe(F.col(f"__s{i}")) for i, c in enumerate(series)]
    start = F.col("__t") - back
    here = F.when(F.col("__t").isNull(), F.col("__ab") == F.col("__b")).otherwise(
        (F.col("__ahi") >= start) & (F.col("__alo").isNull() | (F.col("__alo") < start)))
    asks = dealt.join(broadcast_if_small(pairs), [*to, here]).select(
        *series, F.col("__ab").alias("__in"), start.alias("__at"), F.lit(0).alias("__side"), F.struct(*names).alias("__row"),
        (F.col("__upto") + F.col("__gap")).alias("__upto"))
    known = dealt.where("__rank = 1").select(*series, F.col("__b").alias("__in"), F.col("__t").alias("__at"), F.lit(1).alias("__side"), F.col("__first").alias("__known"))
    # backwards in time, the last known one is the first at or after what is asked for
    back_on = Window.partitionBy(*series, "__in").orderBy(F.desc("__at"), F.desc("__side")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    met = asks.unionByName(known, allowMissingColumns=True).withColumn("__known", F.last("__known", ignorenulls=True).over(back_on))
    return met.where("__side = 0").select("__row.*", (F.col("__upto") - F.col("__known")).alias("__held"))


def counter_rate(df: DataFrame, series: Sequence[str], ts: str, value: str, range_seconds: int = 60) -> DataFrame:
    """Per sample: reset-aware increase over the last ``range_seconds`` and rate = increase / range.

    increase = sum over consecutive sample pairs inside [t - range, t] of
    (v - prev if v >= prev else v). No extrapolation to the window edges. Samples of one time
    are in the order of their values.
    """
    series, back = list(series), range_seconds * 1_000_000
    rows = df.withColumn("__t", _us(ts))
    if _largest(df, series) <= FRAME_ROWS:
        w = Window.partitionBy(*series).orderBy("__t", value)
        step = _step(F.lag(value).over(w), F.col(value))
        rows = rows.withColumn("__inc", step)
        wr = Window.partitionBy(*series).orderBy("__t").rangeBetween(-back, 0)
        # the first pair of the window starts before it
        first = F.min_by(F.coalesce("__inc", F.lit(0.0)), F.struct("__t", value)).over(wr)
        rows = rows.withColumn("increase", F.coalesce(F.sum("__inc").over(wr), F.lit(0.0)) - first).drop("__inc")
    else:
        rows = _held(rows, series, back, value).withColumnRenamed("__held", "increase")
    out = rows.select(*df.columns, "increase")
    return out.withColumn("rate", F.col("increase") / float(range_seconds))


def _step(prev, value):
    return F.when(prev.isNull() | value.isNull(), F.lit(None)).when(value >= prev, value - prev).otherwise(value)


def window_count_rate(df: DataFrame, series: Sequence[str], ts: str, range_seconds: int = 60) -> DataFrame:
    """Per sample: events in the last ``range_seconds`` and events per second."""
    series, back = list(series), range_seconds * 1_000_000
    rows = df.withColumn("__t", _us(ts))
    if _largest(df, series) <= FRAME_ROWS:
        wr = Window.partitionBy(*series).orderBy("__t").rangeBetween(-back, 0)
        rows = rows.withColumn("n_window", F.count(F.lit(1)).over(wr))
    else:
        rows = _held(rows, series, back, None).withColumn("n_window", F.col("__held") + 1)
    return rows.select(*df.columns, "n_window").withColumn("per_second", F.col("n_window") / float(range_seconds))


def sustained_intervals(df: DataFrame, series: Sequence[str], ts: str, condition, min_seconds) -> DataFrame:
    """Runs of consecutive samples meeting ``condition`` that last >= ``min_seconds``.

    ``min_seconds`` is a number or the name of a column that is part of ``series``.

    Island id = number of failing samples before a row in its series: a
    running count computed by the bucketed ordered scan, then one aggregation
    per island -- no window over a whole series.
    """
    series = list(series)
    d = df.select(*series, F.col(ts).alias("__ts"), _us(ts).alias("__t"),
                  condition.alias("__ok")).withColumn("__bad", F.when(F.col("__ok"), 0).otherwise(1).cast("long"))
    sc = ordered_scan(d, series, "__t", ["__bad"], next_col="__next", most=df.count())
    isl = sc.filter(F.col("__ok")).groupBy(*series, F.col("cum___bad").alias("__island")).agg(
        F.min("__ts").alias("start_ts"), F.max("__ts").alias("end_ts"), F.count(F.lit(1)).alias("n_samples"),
        ((F.max("__t") - F.min("__t")) / 1e6).alias("held_seconds"))
    bound = F.col(min_seconds) if isinstance(min_seconds, str) else F.lit(float(min_seconds))
    return isl.filter(F.col("held_seconds") >= bound).drop("__island")


def cumulative_buckets(df: DataFrame, by: Sequence[str], value: str, bounds: Sequence[float]) -> DataFrame:
    """Histogram as cumulative counts per upper bound ``le`` (+Inf last)."""
    by = list(by)
    les = list(bounds) + [float("inf")]
    counts = df.groupBy(*by).agg(*[F.count_if(F.col(value) <= F.lit(le)).alias(f"b{i}") for i, le in enumerate(les)])
    return counts.select(*by, F.inline(F.array(*[
        F.struct(F.lit(le).alias("le"), F.col(f"b{i}").alias("count")) for i, le in enumerate(les)])))


def histogram_quantile(buckets: DataFrame, by: Sequence[str], q: float) -> DataFrame:
    """Quantile from cumulative buckets, linear inside the bucket.

    Lower edge of the first bucket is 0; a rank in the +Inf bucket returns the
    largest finite bound. Runs on one row per (group, bound).
    """
    by = list(by)
    w = Window.partitionBy(*by).orderBy("le")
    b = buckets.withColumns({"__prev_le": F.lag("le").over(w), "__prev_n": F.lag("count").over(w),
                             "__total": F.max("count").over(Window.partitionBy(*by))})
    b = b.withColumn("__rank", F.lit(q) * F.col("__total"))
    hit = b.filter(F.col("count") >= F.col("__rank")).groupBy(*by).agg(
        F.min_by(F.struct("le", "count", "__prev_le", "__prev_n", "__rank"), F.col("le")).alias("h"))
    finite_max = buckets.filter(F.col("le") != float("inf")).groupBy(*by).agg(F.max("le").alias("__fmax"))
    hit = hit.join(finite_max, by, "left")
    lower = F.coalesce(F.col("h.__prev_le"), F.lit(0.0))
    prev_n = F.coalesce(F.col("h.__prev_n"), F.lit(0))
    interp = lower + (F.col("h.le") - lower) * F.try_divide(F.col("h.__rank") - prev_n, F.col("h.count") - prev_n)
    val = F.when(F.col("h.le") == float("inf"), F.col("__fmax")).otherwise(interp)
    return hit.select(*by, val.alias("quantile"))


def latest_value(df: DataFrame, series: Sequence[str], ts: str, value: str) -> DataFrame:
    """Instant value: last non-null sample per series."""
    return (df.filter(F.col(value).isNotNull()).groupBy(*series)
              .agg(F.max_by(F.struct(F.col(ts).alias("ts"), F.col(value).alias("value")), F.col(ts)).alias("l"))
              .select(*series, "l.ts", "l.value"))


def instant_vector(df: DataFrame, series: Sequence[str], ts: str, value: str, step_seconds: int) -> DataFrame:
    """Last sample per series at each evaluation step (floor of ts to the step) (J09 input)."""
    step = F.timestamp_seconds(F.floor(_us(ts) / (step_seconds * 1_000_000)) * step_seconds)
    return (df.groupBy(*series, step.alias("eval_ts"))
              .agg(F.max_by(F.col(value), F.col(ts)).alias("value")))


def guarded_match(a: DataFrame, b: DataFrame, on: Sequence[str]) -> DataFrame:
    """``a and b``: keep samples of ``a`` that have a sample of ``b`` with equal labels."""
    return a.join(b, list(on), "left_semi")


def missing_series(expected: DataFrame, observed: DataFrame, name: str) -> DataFrame:
    """Expected names minus observed names."""
    return expected.join(observed.select(name).distinct(), name, "left_anti")


def outside_band(value, low: float, high: float):
    """value > high or value < low."""
    return (value > high) | (value < low)
