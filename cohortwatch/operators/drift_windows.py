"""Drift of many overlapping windows against one large reference.

A grouped drift job copies the reference's value counts to every window. Here the reference
is looked up instead, whole, once:

* **Numeric columns.** Between two neighbouring values of a window its CDF is a constant
  c = i / n, so the Wasserstein distance is a sum over the window's own values of the integral of
  |F - c|, where F is the reference's CDF. With A(x), the integral of F up to x, each part is a
  difference of A at the two values and at the point where F passes c. F and A at every row are
  running sums of the reference's counts over the union of reference and rows, ordered by
  value (one ordered scan for all windows); the passing points of the levels i / n come from a
  second scan ordered by share. A row then goes to its windows as four numbers.
* **Other columns.** Rows are counted per block, whose bounds are the windows' bounds, and a
  window adds the counts of its blocks, never its rows. Reference values that a window lacks
  enter the Jensen-Shannon sum as one number, the share they have left.

This covers the distance tests, which a reference of more than ``SMALL_REFERENCE_ROWS`` rows
has. A smaller one is small enough to go to every window.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cohortwatch.operators import drift as D
from cohortwatch.operators.scan import ordered_scan
from cohortwatch.session import cut_lineage

KEYS = ["column", "kind", "vnum", "vtxt"]


def value_counts(rows: DataFrame, numeric: Sequence[str], categorical: Sequence[str]) -> DataFrame:
    """(column, kind, vnum, vtxt, n) of the reference, written once."""
    return cut_lineage(D.long_form(rows, numeric, categorical).groupBy(*KEYS).agg(F.count(F.lit(1)).alias("n")))


def reference_facts(counts: DataFrame) -> DataFrame:
    """One row per column of the reference: n_ref, ref_values, mean and population std of numeric values."""
    w = F.col("n") * F.col("vnum")
    first = counts.groupBy("column", "kind").agg(F.sum("n").alias("n_ref"), F.count(F.lit(1)).alias("ref_values"), F.try_divide(F.sum(w), F.sum("n")).alias("mean"))
    spread = counts.join(F.broadcast(first.select("column", "mean")), "column").groupBy("column").agg(
        F.sqrt(F.sum(F.col("n") * (F.col("vnum") - F.col("mean")) ** 2) / F.sum("n")).alias("std_ref"))
    return cut_lineage(first.join(spread, "column"))


def numeric_windows(counts: DataFrame, facts: DataFrame, rows: DataFrame, columns: Sequence[str], tag: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """(check_id, column, n_cur, w1_norm) of every window and column with values.

    ``rows`` holds __seq and the columns; ``tag`` gives a frame with __seq one row per window
    (``check_id``) that holds it.
    """
    facts = F.broadcast(facts.where("kind = 'num'").select("column", "n_ref", "mean", "std_ref"))  # one row a column
    # values are taken from the reference's mean, which keeps the sums small
    ref = counts.where("kind = 'num'").join(facts, "column").select("column", (F.col("vnum") - F.col("mean")).alias("v"), "n")
    wide = rows.select("__seq", *[(F.col(c).cast("double") + 0.0).alias(f"__v{i}") for i, c in enumerate(columns)])
    long = wide.unpivot(["__seq"], [F.col(f"__v{i}").alias(c) for i, c in enumerate(columns)], "column", "v")
    long = long.where(F.col("v").isNotNull() & ~F.isnan("v") & (F.abs("v") != float("inf"))).join(facts, "column").select("column", (F.col("v") - F.col("mean")).alias("v"), "__seq")
    both = (ref.select("column", "v", F.lit(None).cast("long").alias("__seq"), F.col("n").alias("c"), (F.col("n") * F.col("v")).alias("s"))
            .unionByName(long.select("column", "v", "__seq", F.lit(0).cast("long").alias("c"), F.lit(0.0).alias("s"))))
    placed = cut_lineage(ordered_scan(both, ["column"], "v", ["c", "s"], peers=True))
    # F and A at every row
    share, area = F.col("cum_c") / F.col("n_ref"), (F.col("v") * F.col("cum_c") - F.col("cum_s")) / F.col("n_ref")
    own = placed.where("__seq is not null").join(facts, "column").select("__seq", "column", "v", area.alias("a"))
    tagged = tag(own)
    sizes = tagged.groupBy("check_id", "column").agg(F.count(F.lit(1)).alias("n_cur"), F.max("v").alias("last"))
    sizes = cut_lineage(sizes)
    cross = passing_points(placed.where("__seq is null").join(facts, "column").withColumn("share", share), sizes)
    order = Window.partitionBy("check_id", "column").orderBy("v", "__seq")  # one window's rows
    ranked = tagged.withColumns({"i": F.row_number().over(order), "to": F.lead("v").over(order), "a_to": F.lead("a").over(order)})
    ranked = ranked.join(sizes.drop("last"), ["check_id", "column"]).join(cross, ["column", "n_cur", "i"], "left")
    c, step, gain = F.col("i") / F.col("n_cur"), F.col("to") - F.col("v"), F.col("a_to") - F.col("a")
    split = c * (F.col("x") - F.col("v")) - (F.col("a_x") - F.col("a")) + (F.col("a_to") - F.col("a_x")) - c * (F.col("to") - F.col("x"))
    part = F.when(F.col("x") <= F.col("v"), gain - c * step).when(F.col("x") >= F.col("to"), c * step - gain).otherwise(split)
    before = F.when(F.col("i") == 1, F.col("a")).otherwise(0.0)
    sums = ranked.groupBy("check_id", "column", "n_cur").agg(F.sum(F.coalesce(F.greatest(part, F.lit(0.0)), F.lit(0.0)) + before).alias("inner"),
                                                            F.max("v").alias("v"), F.max_by("a", "v").alias("a"))
    # beyond the window's last value v the reference has the rest: the integral of 1 - F is A(v) - v, its mean being 0
    w1 = F.col("inner") + F.greatest(F.col("a") - F.col("v"), F.lit(0.0))
    return sums.join(facts, "column").select("check_id", "column", "n_cur", (w1 / F.greatest(F.col("std_ref"), F.lit(D.STD_FLOOR))).alias("w1_norm"))


def passing_points(ref: DataFrame, sizes: DataFrame) -> DataFrame:
    """(column, n_cur, i, x, a_x): where the reference's CDF passes i / n_cur, and A there, for every window size met.

    ``ref`` has a row per reference value with its cumulative ``share``. Steps between neighbouring
    values, and these times the share, are summed up over the shares: the sums up to a level are
    the place of the next value and A there. A share that equals a level may count as below or
    above, since F - c is 0 from there to the next value.
    """
    levels = (sizes.select("column", "n_cur").distinct().where("n_cur > 1")
              .select("column", "n_cur", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n_cur") - 1)).alias("i")))
    step = F.coalesce(F.col("next_value") - F.col("v"), F.lit(0.0))
    steps = ref.where("c > 0").select("column", "v", "c", "share").transform(lambda d: ordered_scan(d, ["column"], "v", ["c"], cum_prefix="again_"))
    steps = steps.select("column", "share", step.alias("d"), (step * F.col("share")).alias("e"), F.lit(None).cast("long").alias("n_cur"), F.lit(None).cast("long").alias("i"))
    first = ref.groupBy("column").agg(F.min("v").alias("least"))  # one row a column
    asked = levels.select("column", (F.col("i") / F.col("n_cur")).alias("share"), F.lit(0.0).alias("d"), F.lit(0.0).alias("e"), "n_cur", "i")
    scanned = ordered_scan(steps.unionByName(asked), ["column"], "share", ["d", "e"], peers=True)
    return scanned.where("i is not null").join(F.broadcast(first), "column").select(
        "column", "n_cur", F.col("i").cast("int").alias("i"), (F.col("least") + F.col("cum_d")).alias("x"), F.col("cum_e").alias("a_x"))


def counted_windows(counts: DataFrame, facts: DataFrame, blocks: DataFrame, tag: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """(check_id, column, kind, n_cur, n_values, js) of every window and column with values.

    ``blocks`` holds (__seq, column, kind, vnum, vtxt, n): counts per block, named by its first row.
    """
    current = tag(blocks).groupBy("check_id", *KEYS).agg(F.sum("n").alias("n_c"))
    facts = F.broadcast(facts.select("column", "n_ref", "ref_values"))
    same = [F.col(f"r.{k}").eqNullSafe(F.col(f"c.{k}")) for k in KEYS]
    met = (current.alias("c").join(counts.alias("r"), same, "left")
           .select("c.check_id", "c.column", "c.kind", "c.n_c", F.coalesce("r.n", F.lit(0)).alias("n_r")))
    total = Window.partitionBy("check_id", "column")  # one row per value of a window
    met = met.join(facts, "column").withColumn("n_cur", F.sum("n_c").over(total))
    p, q = F.col("n_r") / F.col("n_ref"), F.col("n_c") / F.col("n_cur")
    m = (p + q) / 2.0
    kl = F.when(p > 0, p * F.log(p / m)).otherwise(0.0) + F.when(q > 0, q * F.log(q / m)).otherwise(0.0)
    sums = met.groupBy("check_id", "column", "kind", "n_cur").agg(
        F.sum(kl).alias("kl"), F.sum("n_r").alias("seen"), F.max("n_ref").alias("n_ref"),
        (F.max("ref_values") + F.count_if(F.col("n_r") == 0)).alias("n_values"))
    lacking = F.greatest(1.0 - F.col("seen") / F.col("n_ref"), F.lit(0.0)) * F.log(F.lit(2.0))
    return sums.select("check_id", "column", "kind", "n_cur", "n_values", F.sqrt(F.greatest((F.col("kl") + lacking) / 2.0, F.lit(0.0))).alias("js"))


def windows_table(counts: DataFrame, rows: DataFrame, blocks: DataFrame, checks: DataFrame, numeric: Sequence[str], categorical: Sequence[str],
                  tag: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """(check_id, column, kind, n_ref, n_cur, test, statistic, drifted): the drift table of all windows.

    Every window of ``checks`` has every column. A column without values in a window has
    drifted; one without reference values cannot be judged and has not.
    """
    facts = reference_facts(counts)
    listed = F.array(*[F.struct(F.lit(c).alias("column"), F.lit(kind).alias("kind")) for kind, names in (("num", numeric), ("cat", categorical)) for c in names])
    every = checks.select("check_id", F.inline(listed)).join(F.broadcast(facts.select("column", "n_ref", "ref_values")), "column", "left")
    counted = counted_windows(counts, facts, blocks, tag).select("check_id", "column", "n_values", "js", F.col("n_cur").alias("n_counted"))
    out = every.join(counted, ["check_id", "column"], "left")
    if numeric:
        out = out.join(numeric_windows(counts, facts, rows, numeric, tag).select("check_id", "column", "n_cur", "w1_norm"), ["check_id", "column"], "left")
    else:
        out = out.withColumns({"n_cur": F.lit(None).cast("long"), "w1_norm": F.lit(None).cast("double")})
    out = out.withColumns({"n_ref": F.coalesce("n_ref", F.lit(0)), "n_cur": F.coalesce("n_cur", "n_counted", F.lit(0))})
    by_value = (F.col("kind") == "cat") | (F.col("n_values") <= D.FEW_VALUES)
    out = out.withColumns({"test": F.when(by_value, "jensenshannon").otherwise("wasserstein"),
                           "statistic": F.when(by_value, F.col("js")).otherwise(F.col("w1_norm"))})
    emptied = (F.col("n_ref") > 0) & (F.col("n_cur") == 0)
    drifted = (F.col("n_ref") > 0) & (emptied | F.coalesce(F.col("statistic") >= D.DISTANCE_THRESHOLD, F.lit(False)))
    return out.select("check_id", "column", "kind", "n_ref", "n_cur", "test", "statistic", drifted.alias("drifted"))
