"""Row-count windows over an arrival sequence.

A "last N rows" frame over a global order is an unpartitioned window in SQL,
which runs in one task. Here the sequence is cut into blocks of N rows: a row's
frame covers its own block up to itself plus the tail of the previous block.
Each block is a window partition of N rows, and the tail sum of the previous
block arrives by an equi-join on (block, offset), so the work spreads over
all blocks and no task ever holds more than one block.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cohortwatch.operators.scan import ordered_scan


def rolling_rows(df: DataFrame, seq: str, value: str, n: int, decimal_scale: int | None = None) -> DataFrame:
    """Per row: count, sum of ``value`` over the last ``n`` rows by ``seq`` (inclusive).

    ``seq`` gives the order only: rows are numbered by it first (``ordered_scan``), so it
    may have gaps. With ``decimal_scale`` the sums are
    exact decimals (the values have that many decimal places).
    """
    x = F.col(value)
    if decimal_scale is not None:
        x = x.cast(f"decimal(18,{decimal_scale})")
    rows = df.select(F.col(seq), x.alias("__v"), F.lit(1).cast("long").alias("__one"))
    base = ordered_scan(rows, [], seq, ["__one"], stored_input=True, most=df.count()).select(F.col(seq), "__v", (F.col("cum___one") - 1).alias("__p"))
    base = base.withColumns({"__b": F.floor(F.col("__p") / n).cast("long"),
                             "__o": (F.col("__p") % n).cast("long")})
    w_run = Window.partitionBy("__b").orderBy("__o").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    w_all = Window.partitionBy("__b")
    pref = base.withColumns({
        "__pre": F.sum("__v").over(w_run),
        "__tot": F.sum("__v").over(w_all),
    })
    # tail of block b-1 after offset o, to be added to row (b, o)
    carry = pref.select((F.col("__b") + 1).alias("__b"), F.col("__o"),
                        (F.col("__tot") - F.col("__pre")).alias("__carry"))
    out = pref.join(carry, ["__b", "__o"], "left")
    total = F.col("__pre") + F.coalesce(F.col("__carry"), F.lit(0))
    return out.select(
        F.col(seq),
        F.least(F.col("__p") + 1, F.lit(n)).cast("long").alias("n_window"),
        total.cast("double").alias("sum_window"),
    )
