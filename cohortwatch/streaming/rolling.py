"""Count-based rolling drift over served rows.

Rule: rows arrive in batches; the buffer keeps the last ``window`` rows; a
check is due after a batch when at least ``min_new`` rows arrived since the
last check and the buffer holds at least ``min_window`` rows; the counter
resets at each check.

``replay`` evaluates that rule over a stored arrival sequence with a constant
batch size. The due batches then follow a closed form (first due batch k0,
then every s batches, plus possibly the final short batch), so every row and
every block of rows can compute which check windows contain it arithmetically.
All checks are one job against the whole reference (``operators.drift_windows``):
no loop, no range join, no task that holds the whole sequence, and no copy of
the reference per check.

The live form (micro-batches of any size) is ``RollingDriftMonitor`` in
``cohortwatch.streaming.monitor``.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortwatch.operators import drift as D
from cohortwatch.operators import drift_windows as W
from cohortwatch.operators.scan import ordered_scan
from cohortwatch.session import cut_lineage


@dataclass(frozen=True)
class Schedule:
    n_rows: int
    batch: int
    window: int
    first: int | None      # first due batch (1-based), None if never due
    step: int              # batches between checks
    n_regular: int         # checks at first + j * step
    final_short: bool      # the last, short batch is due as well

    @property
    def n_checks(self) -> int:
        return self.n_regular + (1 if self.final_short else 0)


def schedule(n_rows: int, batch: int, window: int, min_new: int, min_window: int) -> Schedule:
    """Closed-form due batches for a constant batch size (scalars only)."""
    n_batches = math.ceil(n_rows / batch) if n_rows else 0
    full = n_rows // batch
    step = max(1, math.ceil(min_new / batch))
    k_new = step                                  # first batch with >= min_new rows since start
    k_win = math.ceil(min(min_window, window) / batch) if min_window <= window else None
    first = max(k_new, k_win) if k_win is not None else None
    if first is None or first > full:
        regular = 0
    else:
        regular = (full - first) // step + 1
    final_short = False
    if n_batches > full and first is not None:     # a short last batch exists
        last_check = first + (regular - 1) * step if regular else 0
        since = (full - last_check) * batch + (n_rows - full * batch)
        final_short = since >= min_new and min(n_rows, window) >= min_window
    return Schedule(n_rows, batch, window, first if regular or final_short else None, step, regular, final_short)


def check_windows(df: DataFrame, seq: str, sch: Schedule, start: int) -> DataFrame:
    """Rows tagged with every ``check_id`` whose window holds them (explode of a short sequence)."""
    p = F.col(seq) - F.lit(start)                 # 0-based arrival position
    b, s, w = sch.batch, sch.step, sch.window
    ids = F.array().cast("array<long>")
    if sch.n_regular:
        k0 = sch.first
        # row p is in check j iff end_j - w <= p < end_j with end_j = (k0 + j s) b
        lo = F.greatest(F.ceil(((p + 1) / b - k0) / s), F.lit(0))
        hi = F.least(F.floor(((p + w) / b - k0) / s), F.lit(sch.n_regular - 1))
        ids = F.when(lo <= hi, F.sequence(lo.cast("long"), hi.cast("long"))).otherwise(ids)
    if sch.final_short:
        in_final = p >= F.lit(sch.n_rows - w)
        ids = F.when(in_final, F.concat(ids, F.array(F.lit(sch.n_regular).cast("long")))).otherwise(ids)
    return df.withColumn("check_id", F.explode(ids))


def checks_table(spark: SparkSession, sch: Schedule) -> DataFrame:
    """(check_id, batch_index, end_row) for every due check."""
    reg = spark.range(sch.n_regular).select(
        F.col("id").alias("check_id"), (F.lit(sch.first or 0) + F.col("id") * sch.step).alias("batch_index"))
    reg = reg.withColumn("end_row", F.col("batch_index") * sch.batch)
    if sch.final_short:
        fin = spark.range(1).select(F.lit(sch.n_regular).cast("long").alias("check_id"),
                                    F.lit(math.ceil(sch.n_rows / sch.batch)).cast("long").alias("batch_index"),
                                    F.lit(sch.n_rows).cast("long").alias("end_row"))
        reg = reg.unionByName(fin)
    return reg


def block_counts(numbered: DataFrame, sch: Schedule, numeric, categorical) -> DataFrame:
    """(__seq, column, kind, vnum, vtxt, n): value counts per block, named by its first row.

    Blocks are cut wherever a window of the schedule may start or end, so a window holds
    whole blocks.
    """
    cuts = {0, -sch.window % sch.batch} | ({(sch.n_rows - sch.window) % sch.batch} if sch.final_short else set())
    p = F.col("__seq")
    start = F.array_max(F.filter(F.array(*[F.lit(c) for c in sorted(cuts)]), lambda c: c <= p % sch.batch))
    named = numbered.withColumn("__block", p - p % sch.batch + start)
    long = D.long_form(named, numeric, categorical, group="__block")
    counts = long.groupBy(D.G, *W.KEYS).agg(F.count(F.lit(1)).alias("n"))
    return counts.select(F.col(D.G).cast("long").alias("__seq"), *W.KEYS, "n")


def replay(reference: DataFrame, served: DataFrame, seq: str, numeric, categorical, *, batch: int,
           window: int, min_new: int, min_window: int) -> tuple[DataFrame, Schedule]:
    """Verdict per due check over the last ``window`` rows (T05), against the whole reference.

    ``seq`` orders the served rows; they are numbered by it, so it may have gaps. Columns with
    more than ``SMALL_REFERENCE_ROWS`` reference values are looked up in the reference
    (``operators.drift_windows``); the values of others are few and go to every check.
    """
    n = served.count()
    sch = schedule(n, batch, window, min_new, min_window)
    spark = served.sparkSession
    numbered = ordered_scan(served.withColumn("__one", F.lit(1).cast("long")), [], seq, ["__one"], stored_input=True, most=n)
    numbered = cut_lineage(numbered.select((F.col("cum___one") - 1).alias("__seq"), *numeric, *categorical))
    checks = checks_table(spark, sch)
    tag = lambda df: check_windows(df, "__seq", sch, 0)
    table = drift_of_windows(reference, numbered, checks, tag, numeric, categorical, lambda num, cat: block_counts(numbered, sch, num, cat))
    verdict = D.dataset_verdict(table, "check_id")
    out = checks.withColumn("n_window", F.least("end_row", F.lit(sch.window)).cast("long")).join(verdict, "check_id")
    return out, sch


def drift_of_windows(reference: DataFrame, rows: DataFrame, checks: DataFrame, tag, numeric, categorical, blocks, counts: DataFrame | None = None) -> DataFrame:
    """(check_id, column, drifted) of every window and column, each by the method its reference size asks for.

    ``blocks(numeric, categorical)`` counts values per block of ``rows``; ``counts`` are the
    reference's value counts where they are kept already.
    """
    counts = W.value_counts(reference, numeric, categorical) if counts is None else counts
    known = {r["column"]: r for r in W.reference_facts(counts).collect()}  # one row a column
    large = {c for c, r in known.items() if r["n_ref"] > D.SMALL_REFERENCE_ROWS}
    num, cat = [c for c in numeric if c in large], [c for c in categorical if c in large]
    few = [c for c in num if known[c]["ref_values"] <= D.FEW_VALUES]
    parts = []
    if num or cat:
        held = counts.where(F.col("column").isin(num + cat))
        parts.append(W.windows_table(held, rows, blocks(few, cat), checks, num, cat, tag))
    num, cat = [c for c in numeric if c not in large], [c for c in categorical if c not in large]
    if num or cat:
        small = D.drift_table(reference, tag(rows), num, cat, group="check_id")
        parts.append(small.withColumn("check_id", F.col("check_id").cast("long")))
    picked = [p.select("check_id", "column", "drifted") for p in parts]
    return picked[0] if len(picked) == 1 else picked[0].unionByName(picked[1])


def states(spark: SparkSession, verdicts: DataFrame, sch: Schedule, enabled: bool = True) -> DataFrame:
    """State after every batch: disabled / warming up / healthy / drift detected."""
    n_batches = math.ceil(sch.n_rows / sch.batch) if sch.n_rows else 0
    k = F.col("batch_index")
    b = spark.range(1, n_batches + 1).select(F.col("id").alias("batch_index"))
    rows_seen = F.least(k * sch.batch, F.lit(sch.n_rows))
    if sch.n_regular:
        last_reg = F.when(k >= sch.first, F.floor((F.least(k, F.lit(sch.first + (sch.n_regular - 1) * sch.step))
                                                    - sch.first) / sch.step)).cast("long")
    else:
        last_reg = F.lit(None).cast("long")
    last = F.when(F.lit(sch.final_short) & (k == n_batches), F.lit(sch.n_regular).cast("long")).otherwise(last_reg)
    b = b.withColumns({"rows_seen": rows_seen, "buffered": F.least(rows_seen, F.lit(sch.window)),
                       "last_check": last})
    v = verdicts.select(F.col("check_id").alias("last_check"), F.col("batch_index").alias("__cb"),
                        F.col("end_row").alias("__ce"), "dataset_drift")
    j = b.join(v, "last_check", "left")
    since = F.when(F.col("__ce").isNull(), F.col("rows_seen")).otherwise(F.col("rows_seen") - F.col("__ce"))
    state = (F.when(F.lit(not enabled), "disabled").when(F.col("dataset_drift").isNull(), "warming up")
             .when(F.col("dataset_drift"), "drift detected").otherwise("healthy"))
    return j.select("batch_index", "rows_seen", "buffered", since.alias("rows_since_check"), "last_check",
                    state.alias("state"))
