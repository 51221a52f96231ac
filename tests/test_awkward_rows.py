"""Rows that fixtures never hold: headers in another order, suffixes, null scores, maps, gaps, emptied columns."""

import math

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortwatch.functions import stats
from cohortwatch.functions.values import split_prefixed_name, to_number
from cohortwatch.operators import asof, clean, drift, encode, evaluate, scan, windows
from cohortwatch.session import shared_path
from cohortwatch.sources import io


def write_text(spark, path, lines):
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(path)


def test_csv_columns_go_by_name(spark):
    path = shared_path(spark, "test-csv")
    write_text(spark, path, ["b,extra,a", "1,x,2", "NA,y,n/a"])
    schema = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.IntegerType())])
    assert sorted(map(tuple, io.read_csv(spark, path, schema).collect()), key=str) == [(2, 1), (None, None)]
    assert io.read_scenario_files(spark, path, schema).select("a", "b").collect()[0] == (2, 1)
    with pytest.raises(ValueError, match="lacks c"):
        io.read_csv(spark, path, schema.add("c", T.StringType()))


def test_plain_numbers_only(spark):
    want = {"12": 12.0, " 7 ": 7.0, "1e3": 1000.0, "-.5": -0.5, "3.": 3.0, "12d": None, "12f": None, "1_000": None, "0x1F": None, "": None, "abc": None, "1 2": None}
    df = spark.createDataFrame([(k,) for k in want] + [(None,)], "x string")
    assert {r.x: r.y for r in df.select("x", to_number("x").alias("y")).collect()} == {**want, None: None}
    assert [r.x for r in encode.impute(df.where("x in ('12d', '12')"), {"x": 5.0}, {}).collect()] == [12.0, 5.0]
    assert [r.x for r in clean.coerce_numeric(df.where("x in ('12d', '12')"), ["x"]).collect()] == [12.0, None]


def test_auc_leaves_out_null_scores(spark):
    rows = [(1, 0.9, "m"), (0, 0.1, "m"), (1, None, "m"), (0, None, "m"), (0, float("nan"), "m"), (None, 0.5, "m"), (1, None, "n")]
    df = spark.createDataFrame(rows, "y int, s double, g string")
    assert tuple(evaluate.roc_auc(df, "y", "s").first()) == (1, 1, 5, 1.0)
    assert {r.g: (r.n_pos, r.n_skipped, r.auc) for r in evaluate.roc_auc(df, "y", "s", by=["g"]).collect()} == {"m": (1, 4, 1.0), "n": (0, 1, None)}


def test_map_columns_ride_along(spark):
    rows = [(1, 1, {"a": 1}), (1, 2, {"b": 2}), (2, 5, None)]
    df = spark.createDataFrame(rows, "k int, t int, m map<string,int>").withColumn("ts", F.timestamp_seconds("t"))
    assert {r.k: r.m for r in clean.first_per_key(df, "k", "t").collect()} == {1: {"a": 1}, 2: None}
    assert {r.k: r.m for r in clean.first_per_key(df, "k", "t", descending=True).collect()} == {1: {"b": 2}, 2: None}
    assert {r.k: r.m for r in asof.latest_per_key(df, "k", "ts", ["m"]).collect()} == {1: {"b": 2}, 2: None}
    asked = spark.createDataFrame([(1, 1), (1, 9), (3, 9)], "k int, q int").withColumn("at", F.timestamp_seconds("q"))
    got = asof.asof_join(asked, df, "k", "at", "ts", ["m"])
    assert {(r.k, r.q): r.m for r in got.collect()} == {(1, 1): {"a": 1}, (1, 9): {"b": 2}, (3, 9): None}


def test_rolling_rows_over_gaps(spark):
    df = spark.createDataFrame([(i, 1.0) for i in (0, 1, 2, 10, 11, 12)], "i long, v double")
    got = [(r.i, r.n_window, r.sum_window) for r in windows.rolling_rows(df, "i", "v", 3).orderBy("i").collect()]
    assert got == [(0, 1, 1.0), (1, 2, 2.0), (2, 3, 3.0), (10, 3, 3.0), (11, 3, 3.0), (12, 3, 3.0)]


def test_an_outlier_does_not_gather_a_column(spark, monkeypatch):
    monkeypatch.setattr(scan, "PLAIN_ROWS", 100)
    monkeypatch.setattr(scan, "RANGE_ROWS", 1000)
    df = spark.range(20_000).select(F.when(F.col("id") == 0, 1e15).otherwise(F.col("id").cast("double")).alias("x"), F.lit(1).alias("n"))
    got = scan.ordered_scan(df, [], "x", ["n"]).agg(F.max("cum_n"), F.sum("cum_n")).first()
    assert tuple(got) == (20_000, 20_000 * 20_001 // 2)
    sizes = [r["count"] for r in df.repartitionByRange(20, "x").groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) >= 18 and max(sizes) < 3 * 20_000 / 20


def test_an_emptied_column_is_reported(spark):
    ref = spark.range(200).select((F.col("id") % 10).cast("double").alias("v"), F.col("id").cast("double").alias("w"), F.lit(None).cast("string").alias("z"), F.lit("a").alias("g"))
    cur = ref.withColumn("w", F.lit(None).cast("double"))
    for group in (None, "g"):
        t = drift.drift_table(ref, cur, ["v", "w"], ["z"], group)
        assert {r.column: (r.drifted, r.n_ref, r.n_cur) for r in t.collect()} == {"v": (False, 200, 200), "w": (True, 200, 0), "z": (False, 0, 0)}
        v = drift.dataset_verdict(t, group).first()
        assert (v.n_columns, v.n_drifted, v.drifted_columns) == (3, 1, "w")


def test_p_values_at_any_size(spark):
    ref = spark.range(3000).select(F.col("id").cast("double").alias("x"), F.when(F.col("id") % 3 == 0, "a").when(F.col("id") % 3 == 1, "b").otherwise("c").alias("k"),
                                   F.when(F.col("id") % 2 == 0, "y").otherwise("n").alias("two"))
    t = {r.column: r for r in drift.drift_table(ref, ref, ["x"], ["k", "two"]).collect()}
    assert t["x"].test == "wasserstein" and t["x"].p_value is None and t["x"].ks_p == pytest.approx(1.0)
    assert t["k"].chi2_p == pytest.approx(1.0) and t["two"].z_p == pytest.approx(1.0)
    assert {r.test for r in drift.drift_table(ref, ref, ["x"], ["k", "two"], regime="pvalue").collect()} == {"ks", "chisquare", "z"}
    with pytest.raises(ValueError):
        drift.drift_table(ref, ref, ["x"], [], regime="other")


def test_tails_against_known_values(spark):
    one = spark.range(1)
    z = [0.0, 0.5, 1.0, 1.959963984540054, 3.0]
    got = one.select(*[stats.normal_two_sided_p(F.lit(x)).alias(f"z{i}") for i, x in enumerate(z)]).first()
    assert list(got) == pytest.approx([math.erfc(x / math.sqrt(2)) for x in z], abs=2e-7)
    # textbook quantiles: 5 % and 1 % points of chi-square; Kolmogorov's 5 % point
    points = [(3.841458820694124, 1, 0.05), (5.991464547107979, 2, 0.05), (11.070497693516351, 5, 0.05), (23.209251158954356, 10, 0.01), (124.34211340400407, 100, 0.05)]
    got = one.select(*[stats.chi2_sf(F.lit(x), F.lit(d)).alias(f"c{i}") for i, (x, d, _) in enumerate(points)]).first()
    assert list(got) == pytest.approx([p for *_, p in points], abs=1e-6)
    n = 20_000
    d = 1.3580986393225505 / math.sqrt(n * n / (n + n))
    assert one.select(stats.ks_p_value(F.lit(d), F.lit(n), F.lit(n))).first()[0] == pytest.approx(0.05, abs=1e-6)


def test_long_categories_are_not_cut(spark):
    name = "col_" + "x" * 1_200_000
    _, category = split_prefixed_name(F.lit(name), ["col"])
    assert spark.range(1).select(F.length(category)).first()[0] == 1_200_000


def test_too_many_categories_raise(spark, monkeypatch):
    monkeypatch.setattr(encode, "MAX_VOCABULARY", 5)
    with pytest.raises(ValueError, match="more than 5"):
        encode.vocabularies(spark.range(9).select(F.col("id").cast("string").alias("c")), ["c"])
