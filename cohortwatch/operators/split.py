"""Repeatable splits and samples.

Every row's position is its rank by md5('key|seed') inside its class, so the
result does not depend on partitioning, retries or executor loss, and any SQL
engine with md5 gives the same rows.

The rank is computed without a window over a whole class (a class can hold a
third of all rows): rows are bucketed by the first hex digits of their hash,
bucket counts are aggregated (map-side combined), a running sum over the
bucket counts gives each bucket's offset inside its class, and the exact rank
inside a bucket comes from a window over (class, bucket) -- about
n_class / 16**digits rows per window partition.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from cohortwatch.functions.values import hash_order, hash_draw
from cohortwatch.session import cut_lineage

# Tables of up to so many bytes are broadcast; beyond it the join shuffles.
BROADCAST_MAX_BYTES = 64 * 1024 * 1024


def row_bytes(schema: T.StructType) -> int:
    """About what a row takes: 8 bytes a number, 64 a text, 256 anything nested."""
    sizes = {T.StringType: 64, T.BinaryType: 64, T.ArrayType: 256, T.MapType: 256, T.StructType: 256}
    return 16 + sum(sizes.get(type(f.dataType), 8) for f in schema.fields)


def broadcast_if_small(df: DataFrame, max_bytes: int = BROADCAST_MAX_BYTES, materialize: bool = True) -> DataFrame:
    """Broadcast only after counting rows, times the bytes of one: a checked size, else a shuffle join.

    With ``materialize`` the side is written once to the checkpoint folder
    first, so the count and the join read the stored rows instead of running
    the upstream aggregation twice; pass False when the side is already cheap
    to recompute (derived from a stored table).
    """
    if materialize:
        df = cut_lineage(df)
    return F.broadcast(df) if df.count() * row_bytes(df.schema) <= max_bytes else df


def _hash_buckets(df: DataFrame, key: str, seed: int, by: Sequence[str], digits: int) -> DataFrame:
    """``df`` with its hash __h, bucket __bk, and of the bucket: rows before it (__off), its own (__bn), its class's (__total)."""
    by = list(by)
    h = hash_order(key, seed)
    base = df.withColumns({"__h": h, "__bk": F.substring(h, 1, digits)})
    counts = base.groupBy(*by, "__bk").agg(F.count(F.lit(1)).alias("__bn"))
    group = Window.partitionBy(*by)
    w = group.orderBy("__bk")
    offsets = counts.select(*[F.col(c).alias(f"__by{i}") for i, c in enumerate(by)], F.col("__bk").alias("__obk"), "__bn",
                            (F.sum("__bn").over(w) - F.col("__bn")).alias("__off"), F.sum("__bn").over(group).alias("__total"))
    # nulls in `by` must meet nulls: join on null-safe equality
    cond = [F.col("__bk") == F.col("__obk")] + [F.col(c).eqNullSafe(F.col(f"__by{i}")) for i, c in enumerate(by)]
    return base.join(broadcast_if_small(offsets), cond, "inner").drop("__obk", *[f"__by{i}" for i in range(len(by))])


def hash_rank(df: DataFrame, key: str, seed: int, by: Sequence[str] = (), digits: int = 4,
              rank_col: str = "__rank") -> DataFrame:
    """Add ``rank_col``: 1-based rank by (md5('key|seed'), key) within ``by`` groups."""
    joined = _hash_buckets(df, key, seed, by, digits)
    w_in = Window.partitionBy(*by, "__bk").orderBy("__h", key)
    return joined.withColumn(rank_col, F.col("__off") + F.row_number().over(w_in)).drop("__h", "__bk", "__off", "__bn", "__total")


def hash_first(df: DataFrame, key: str, seed: int, by: Sequence[str], cut: Callable[[Column], Column],
               digits: int = 4) -> DataFrame:
    """Add ``__first``: whether the row is among the first ``cut(class size)`` of its class by hash order.

    Whole buckets before or behind the cut need no rank; only the bucket in which a class
    is cut (one per class, about class size / 16**digits rows) is shuffled and ranked.
    """
    joined = _hash_buckets(df, key, seed, by, digits).withColumn("__cut", cut(F.col("__total")))
    straddles = (F.col("__off") < F.col("__cut")) & (F.col("__off") + F.col("__bn") > F.col("__cut"))
    w_in = Window.partitionBy(*by, "__bk").orderBy("__h", key)
    settled = joined.where(~straddles).withColumn("__first", F.col("__off") < F.col("__cut"))
    ranked = joined.where(straddles).withColumn("__first", F.col("__off") + F.row_number().over(w_in) <= F.col("__cut"))
    return settled.unionByName(ranked).drop("__h", "__bk", "__off", "__bn", "__total", "__cut")


def stratified_split(df: DataFrame, key: str, label: str, test_size: float, seed: int,
                     split_col: str = "split") -> DataFrame:
    """Per class the first round(test_size * n) rows by hash order are 'test' (W03)."""
    marked = hash_first(df, key, seed, [label], lambda n: F.round(n * float(test_size)))
    return marked.withColumn(split_col, F.when(F.col("__first"), "test").otherwise("train")).drop("__first")


def stratified_folds(df: DataFrame, key: str, label: str, k: int, seed: int, fold_col: str = "fold") -> DataFrame:
    """fold = (rank - 1) % k inside each class."""
    ranked = hash_rank(df, key, seed, [label])
    return ranked.withColumn(fold_col, ((F.col("__rank") - 1) % k).cast("int")).drop("__rank")


def hash_sample(df: DataFrame, key: str, n: int, seed: int) -> DataFrame:
    """min(n, len) rows without replacement, first by hash order."""
    return hash_first(df, key, seed, [], lambda _: F.lit(n)).where("__first").drop("__first")


def number_rows(df: DataFrame, key: str, seed: int, col: str = "position") -> DataFrame:
    """Seeded shuffle: dense position 0..N-1 by hash order."""
    return hash_rank(df, key, seed).withColumn(col, F.col("__rank") - 1).drop("__rank")


def sample_with_replacement(spark, df: DataFrame, key: str, n: int, seed: int, stream: str = "draw") -> DataFrame:
    """n draws; draw i takes row number hash(i) mod N (L04). Output adds ``draw_id``."""
    numbered = number_rows(df, key, seed, "__pos")
    total = df.agg(F.count(F.lit(1))).scalar()
    draws = spark.range(n).select(F.col("id").alias("draw_id"),
                                  (hash_draw("id", seed, stream) % total).alias("__pos"))
    return draws.join(numbered, "__pos", "inner").drop("__pos")


def batch_ids(df: DataFrame, position: str, batch_size: int, col: str = "batch_id") -> DataFrame:
    """batch = floor(position / batch_size)."""
    return df.withColumn(col, F.floor(F.col(position) / batch_size).cast("long"))


def blend(spark, clean: DataFrame, drifted: DataFrame, key: str, n: int, fraction: float, seed: int) -> DataFrame:
    """Row mix: n*(1-f) draws from ``clean`` and n*f from ``drifted``."""
    n_drift = int(round(n * fraction))
    a = sample_with_replacement(spark, clean, key, n - n_drift, seed, "clean").withColumn("source", F.lit("clean"))
    b = sample_with_replacement(spark, drifted, key, n_drift, seed, "drifted").withColumn("source", F.lit("drifted"))
    mixed = a.unionByName(b)
    # shuffle the mixed rows repeatably by (source, draw)
    mixed = mixed.withColumn("__mix_key", F.concat_ws(":", "source", F.col("draw_id").cast("string")))
    return number_rows(mixed, "__mix_key", seed, "position").drop("__mix_key")
