"""Skew: one key holds a third of all rows; the heavy windows must spread it over many tasks.

The output partitions of the window stage show where each row was processed.
AQE partition coalescing is switched off here so small test data keeps the
shuffle layout visible.
"""

import pytest
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cohortwatch.operators import asof as A
from cohortwatch.operators import scan
from cohortwatch.operators import split as SP
from cohortwatch.operators import timeseries as TS
from cohortwatch.plans.fixtures import read_table


@pytest.fixture()
def no_coalesce(spark):
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    old = spark.conf.get(key)
    spark.conf.set(key, "false")
    yield
    spark.conf.set(key, old)


def _hot_events(spark, small_dir):
    ev = read_table(spark, small_dir, "events")
    # every third user is folded into user 0: one key with a third of the rows
    return ev.withColumn("user_id", F.when(F.col("user_id") % 3 == 0, F.lit(0)).otherwise(F.col("user_id")))


def _spread(df, is_hot):
    """Number of output partitions (tasks) that hold rows of the hot key."""
    counts = df.rdd.mapPartitions(lambda rows: [sum(1 for r in rows if is_hot(r))]).collect()
    return sum(1 for c in counts if c)


@pytest.fixture()
def ranges(monkeypatch):
    """Small bounds, as if the tables were large."""
    monkeypatch.setattr(scan, "PLAIN_ROWS", 20)
    monkeypatch.setattr(scan, "RANGE_ROWS", 20)
    monkeypatch.setattr(TS, "FRAME_ROWS", 20)


def test_asof_spreads_hot_key(spark, small_dir, no_coalesce, ranges):
    ev = _hot_events(spark, small_dir)
    clicks = ev.filter("event_type = 'click'").select("event_id", "user_id", "ts")
    buys = ev.filter("event_type = 'purchase'").select(F.col("event_id").alias("p_id"), "user_id",
                                                       F.col("ts").alias("p_ts"))
    out = A.asof_join(clicks, buys, "user_id", "ts", "p_ts", ["p_id"], tie_breaker="p_id")
    naive = clicks.withColumn("r", F.row_number().over(Window.partitionBy("user_id").orderBy("ts")))
    assert _spread(naive, lambda r: r.user_id == 0) == 1
    assert _spread(out, lambda r: r.user_id == 0) >= 4


def test_hash_rank_spreads_hot_class(spark, small_dir, no_coalesce):
    od = read_table(spark, small_dir, "orders").withColumn(
        "cls", F.when(F.col("o_orderkey") % 3 == 0, F.lit("hot")).otherwise(F.col("o_orderstatus")))
    ranked = SP.hash_rank(od.select("o_orderkey", "cls"), "o_orderkey", 42, ["cls"], digits=2)
    assert _spread(ranked, lambda r: r.cls == "hot") >= 4


def test_series_window_spreads_hot_series(spark, small_dir, no_coalesce, ranges):
    ev = _hot_events(spark, small_dir)
    out = TS.window_count_rate(ev, ["user_id"], "ts", 60)
    assert _spread(out, lambda r: r.user_id == 0) >= 4


def test_a_third_of_the_rows_in_one_key_and_one_day(spark, ranges, no_coalesce):
    """No (key, range) of the as-of join holds more than a small share of the rows."""
    rows = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"),
                                    F.timestamp_seconds(F.when(F.col("id") % 3 == 0, F.col("id") * 20).otherwise(F.col("id") * 90_000)).alias("t"), "id")
    out = A.last_known(rows.select("k", F.unix_micros("t").alias("us"), F.when(F.col("id") % 2 == 0, F.col("id")).alias("v")), "k", ["us"], "v")
    parts = out.rdd.mapPartitions(lambda it: [sum(1 for _ in it)]).collect()
    assert max(parts) < 0.3 * 3000 and out.count() == 3000
    hot = {r.us: r["__known"] for r in out.where("k = 0").collect()}
    assert all(hot[us] == us // 20_000_000 // 6 * 6 for us in hot)


def test_a_burst_hour_of_one_series(spark, ranges, no_coalesce):
    """A third of the samples in one hour of one series: its window is a difference of sums over many ranges."""
    df = spark.range(900).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % 100)).alias("s"),
                                 F.timestamp_seconds(F.when(F.col("id") % 3 == 0, F.col("id") * 4).otherwise(F.col("id") * 86_400)).alias("ts"), F.col("id").cast("double").alias("v"))
    got = TS.window_count_rate(df, ["s"], "ts", 600)
    assert _spread(got, lambda r: r.s == "hot") >= 3
    rows = {r.v: r.n_window for r in got.where("s = 'hot'").collect()}
    assert all(n == min(v // 3, 50) + 1 for v, n in rows.items())
