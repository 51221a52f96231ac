"""Ordered scan inside groups without one task per group (helper for CDFs).

``ordered_scan`` adds inclusive running sums and the next ordering value inside each
group, null groups included. Groups of up to ``PLAIN_ROWS`` rows are one window partition
each, which such a size bounds. Where one is larger, the rows are dealt by Spark's range
partitioning over (group, order): ranges of about ``RANGE_ROWS`` rows, whatever the groups and
values, so a group with a third of all rows takes a third of the ranges. Totals per
(group, range) are aggregated, a running sum over one row per range gives each range's
offset, and the exact running sum inside a range is a window over (group, range). The number
of ranges follows the number of rows and has no bound; equal ordering values of one group
share a range.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cohortwatch.session import cut_lineage

# Rows that one window partition may hold.
PLAIN_ROWS = 1_000_000
# Rows of a range of larger groups.
RANGE_ROWS = 250_000


def ordered_scan(df: DataFrame, by: Sequence[str], order: str, sums: Sequence[str], cum_prefix: str = "cum_",
                 next_col: str = "next_value", stored_input: bool = False, most: int | None = None, peers: bool = False) -> DataFrame:
    """Inclusive running sums of ``sums`` and the next ``order`` value inside ``by`` groups.

    Rows without an ordering value are left out. ``most`` is a known bound of the rows of a
    group; without it the groups are counted, for which the input is written first unless it
    is ``stored_input``. With ``peers`` the sums of rows of equal ``order`` include all of them.
    """
    by = list(by)
    df = df.where(F.col(order).isNotNull())
    if most is None or most > PLAIN_ROWS:
        df = df if stored_input else cut_lineage(df)
        sizes = df.groupBy(*by).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n").alias("most"), F.sum("n").alias("rows")).first()
        most = sizes["most"] or 0
    if most <= PLAIN_ROWS:
        return _running(df, by, order, sums, cum_prefix, next_col, peers)
    dealt = df.repartitionByRange(-(-sizes["rows"] // RANGE_ROWS), *by, order).withColumn("__bk", F.spark_partition_id())
    # the ranges come from a sample: written, so that totals and rows see the same ones
    dealt = cut_lineage(dealt)
    totals = dealt.groupBy(*by, "__bk").agg(F.min(order).alias("__least"), *[F.sum(c).alias(f"__bs_{c}") for c in sums])
    over = Window.partitionBy(*by).orderBy("__bk")  # one row per range
    before = over.rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*[F.col(c).alias(f"__by{i}") for i, c in enumerate(by)], F.col("__bk").alias("__obk"),
                            F.lead("__least").over(over).alias("__beyond"),
                            *[F.coalesce(F.sum(f"__bs_{c}").over(before), F.lit(0)).alias(f"__off_{c}") for c in sums])
    same = [F.col("__bk") == F.col("__obk")] + [F.col(c).eqNullSafe(F.col(f"__by{i}")) for i, c in enumerate(by)]
    scanned = _running(dealt.join(offsets, same), [*by, "__bk"], order, sums, cum_prefix, next_col, peers)
    out = scanned.withColumns({**{f"{cum_prefix}{c}": F.col(f"__off_{c}") + F.col(f"{cum_prefix}{c}") for c in sums},
                               next_col: F.coalesce(next_col, "__beyond")})
    return out.drop("__bk", "__obk", "__beyond", *[f"__by{i}" for i in range(len(by))], *[f"__off_{c}" for c in sums])


def _running(df: DataFrame, by: Sequence[str], order: str, sums: Sequence[str], cum_prefix: str, next_col: str, peers: bool) -> DataFrame:
    w = Window.partitionBy(*by).orderBy(order)
    upto = (w.rangeBetween if peers else w.rowsBetween)(Window.unboundedPreceding, Window.currentRow)
    return df.withColumns({**{f"{cum_prefix}{c}": F.sum(c).over(upto) for c in sums}, next_col: F.lead(order).over(w)})
