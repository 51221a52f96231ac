"""Point-in-time feature retrieval.

``asof_join`` gives each entity row the latest feature row of the same key
with feature_ts <= entity_ts, dropped when older than a TTL; no match -> nulls.

Plan (no cross join, no all-pairs, skew-safe):

1. Entity and feature rows are unioned; the last feature row at or before an entity row
   is a running ``last`` in the order of (time, side). Keys of up to ``scan.PLAIN_ROWS`` rows are
   one window partition each, which such a size bounds.
2. Where a key is larger, the rows are dealt by Spark's range partitioning over (key, time), whose
   cuts come from the rows themselves: ranges of about ``scan.RANGE_ROWS`` rows, however many of
   them fall on one key or one day. The last feature of every (key, range) is an aggregate,
   its running ``last`` over one row per range the carry-in of the next ranges, and
   the scan runs inside (key, range).

Keys are compared as in a join: a null key matches nothing. Features without a time, and
entities without one, match nothing either.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cohortwatch.operators import scan
from cohortwatch.operators.clean import row_hash
from cohortwatch.session import cut_lineage


def _micros(c):
    return F.unix_micros(F.col(c).cast("timestamp"))


def asof_join(entities: DataFrame, features: DataFrame, key: str, entity_ts: str, feature_ts: str,
              feature_cols: Sequence[str], ttl_seconds: float | None = None, tie_breaker: str | None = None,
              prefix: str = "") -> DataFrame:
    """Left as-of join; returns entity columns + ``prefix``+feature columns (+ feature ts).

    Among features of equal time the largest ``tie_breaker`` wins, then the largest hash of the
    other columns, so reruns agree.
    """
    payload = [feature_ts] + [c for c in feature_cols if c != feature_ts]
    ties = [F.col(tie_breaker).alias("__tie")] if tie_breaker else [F.lit(0).alias("__tie")]
    feats = features.where(F.col(key).isNotNull()).select(
        F.col(key).alias("__k"), _micros(feature_ts).alias("__us"), F.lit(1).alias("__side"), *ties, row_hash(features, payload).alias("__hash"),
        F.struct(_micros(feature_ts).alias("__us"), *[F.col(c).alias(f"__f_{c}") for c in payload]).alias("__r")).where("__us is not null")
    ents = entities.select(F.col(key).alias("__k"), _micros(entity_ts).alias("__us"), F.lit(2).alias("__side"), F.struct(*entities.columns).alias("__e"))
    rows = last_known(ents.unionByName(feats, allowMissingColumns=True), "__k", ["__us", "__side", "__tie", "__hash"], "__r")
    matched = rows.where("__side = 2")
    ok = F.col("__known").isNotNull()
    if ttl_seconds is not None:
        ok = ok & ((F.col("__us") - F.col("__known.__us")) <= F.lit(int(ttl_seconds * 1_000_000)))
    out = [F.col(f"__e.{c}").alias(c) for c in entities.columns]
    return matched.select(*out, *[F.when(ok, F.col(f"__known.__f_{c}")).alias(f"{prefix}{c}") for c in payload])


def last_known(rows: DataFrame, key: str, order: Sequence[str], value: str) -> DataFrame:
    """``rows`` with ``__known``, the last non-null ``value`` of the key up to the row by ``order`` (nulls first)."""
    by = [F.asc_nulls_first(c) for c in order]
    largest = rows.groupBy(key).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n").alias("most"), F.sum("n").alias("rows")).first()

    def running(keys: list[str]):
        return F.last(value, ignorenulls=True).over(Window.partitionBy(*keys).orderBy(*by).rowsBetween(Window.unboundedPreceding, Window.currentRow))

    if (largest["most"] or 0) <= scan.PLAIN_ROWS:
        return rows.withColumn("__known", running([key]))
    # rows of one key and time stay together; the ranges come from a sample, so they are written
    dealt = rows.repartitionByRange(-(-largest["rows"] // scan.RANGE_ROWS), F.col(key), by[0]).withColumn("__b", F.spark_partition_id())
    dealt = cut_lineage(dealt)
    newest = F.max_by(value, F.when(F.col(value).isNotNull(), F.struct(*order)))
    per_range = dealt.groupBy(key, "__b").agg(newest.alias("__last"))  # one row per range
    before = Window.partitionBy(key).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    carry = per_range.select(F.col(key).alias("__ck"), F.col("__b").alias("__cb"), F.last("__last", ignorenulls=True).over(before).alias("__carry"))
    met = dealt.join(carry, (F.col("__b") == F.col("__cb")) & F.col(key).eqNullSafe(F.col("__ck")))
    return met.withColumn("__known", F.coalesce(running([key, "__b"]), "__carry")).drop("__b", "__ck", "__cb", "__carry")


def latest_per_key(features: DataFrame, key: str, ts: str, cols: Sequence[str], as_of=None,
                   ttl_seconds: float | None = None, tie_breaker: str | None = None) -> DataFrame:
    """Latest row per key with ts <= as_of (W05, J02), as a partial+final max aggregate."""
    src = features
    if as_of is not None:
        src = src.filter(F.col(ts) <= F.lit(as_of).cast(features.schema[ts].dataType))
        if ttl_seconds is not None:
            floor_ts = F.lit(as_of).cast("timestamp") - F.make_interval(secs=F.lit(float(ttl_seconds)))
            src = src.filter(F.col(ts).cast("timestamp") >= floor_ts)
    tie = [F.col(tie_breaker)] if tie_breaker else []
    names = [ts] + [c for c in cols if c != ts]
    row = F.struct(*[F.col(c).alias(f"__f_{c}") for c in names])
    order = F.struct(F.col(ts).alias("__ts"), *[t.alias("__tie") for t in tie], row_hash(features, names).alias("__hash"))
    agg = src.groupBy(key).agg(F.max_by(row, order).alias("__r"))
    return agg.select(F.col(key), *[F.col(f"__r.__f_{c}").alias(c) for c in names])


def lookup_latest(requests: DataFrame, latest: DataFrame, key: str) -> DataFrame:
    """Online-style lookup: every request row gets the latest values, missing -> null."""
    return requests.join(latest, key, "left")


def select_feature_set(df: DataFrame, services: Mapping[str, Sequence[str]], name: str,
                       keys: Sequence[str]) -> DataFrame:
    """Resolve a named feature set to a projection."""
    if name not in services:
        raise KeyError(f"unknown feature set {name}")
    return df.select(*keys, *services[name])
