"""The ways taken by large groups, windows and tables, against plain versions on small data."""

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cohortwatch.operators import drift, evaluate, profile, scan, timeseries, trees
from cohortwatch.operators import model as ML
from cohortwatch.plans.fixtures import read_table
from cohortwatch.session import shared_path
from cohortwatch.streaming import rolling
from cohortwatch.streaming import stream as ST


@pytest.fixture()
def small_ranges(monkeypatch):
    monkeypatch.setattr(scan, "PLAIN_ROWS", 50)
    monkeypatch.setattr(scan, "RANGE_ROWS", 40)


@pytest.mark.parametrize("peers", [False, True])
def test_ranged_scan_equals_a_window(spark, small_ranges, peers):
    """A hot group, a null group and a lone row; ties share their sums with ``peers``."""
    df = spark.range(600).select(
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 50 == 1, None).when(F.col("id") == 2, "one").otherwise(F.concat(F.lit("g"), F.col("id") % 7)).alias("g"),
        (F.col("id") * 37 % (101 if peers else 100_003)).cast("double").alias("x"), (F.col("id") % 5).alias("n"))
    w = Window.partitionBy("g").orderBy("x")
    upto = (w.rangeBetween if peers else w.rowsBetween)(Window.unboundedPreceding, Window.currentRow)
    want = df.select("g", "x", "n", F.sum("n").over(upto).alias("cum_n"), F.lead("x").over(w).alias("next_value"))
    got = scan.ordered_scan(df, ["g"], "x", ["n"], peers=peers).select("g", "x", "n", "cum_n", "next_value")
    key = lambda r: tuple((v is None, v) for v in r)
    if peers:  # which of two equal rows sees itself and which the next value is open
        want, got = want.drop("next_value"), got.drop("next_value")
    assert sorted(map(tuple, got.collect()), key=key) == sorted(map(tuple, want.collect()), key=key)


@pytest.mark.parametrize("ranged", [False, True])
def test_null_groups_keep_their_rows(spark, monkeypatch, ranged):
    if ranged:
        monkeypatch.setattr(scan, "PLAIN_ROWS", 1)
        monkeypatch.setattr(scan, "RANGE_ROWS", 2)
    rows = [(1, 0.9, None), (0, 0.1, None), (1, 0.2, "m"), (0, 0.7, "m"), (0, 0.2, "m")]
    auc = {r.g: (r.n_pos, r.n_neg, r.auc) for r in evaluate.roc_auc(spark.createDataFrame(rows, "y int, s double, g string"), "y", "s", by=["g"]).collect()}
    assert auc == {None: (1, 1, 1.0), "m": (1, 2, 0.25)}
    samples = spark.createDataFrame([(None, t, 9.0) for t in range(0, 40, 5)] + [("a", t, 1.0) for t in range(0, 40, 5)], "label string, t long, v double")
    held = timeseries.sustained_intervals(samples.withColumn("ts", F.timestamp_seconds("t")), ["label"], "ts", F.col("v") > 5, 30).collect()
    assert [(r.label, r.n_samples, r.held_seconds) for r in held] == [(None, 8, 35.0)]


@pytest.mark.parametrize("accuracy", [10_000, 40])
def test_exact_quantiles_by_brackets(spark, monkeypatch, accuracy):
    monkeypatch.setattr(profile, "QUANTILE_ACCURACY", accuracy)
    rng = np.random.default_rng(3)
    data = {"normal": rng.normal(size=1999), "ties": rng.integers(0, 3, 1999).astype(float), "skewed": np.exp(rng.normal(size=1999) * 3), "same": np.full(1999, 2.5)}
    rows = [(*[float(v[i]) for v in data.values()], None, float("nan") if i else 1.0) for i in range(1999)]
    df = spark.createDataFrame(rows, "normal double, ties double, skewed double, same double, none double, one double")
    probs = (0.0, 0.25, 0.5, 0.75, 0.99, 1.0)
    got = {r["column"]: r[1:] for r in profile.exact_quantiles(df, df.columns, probs).collect()}
    for c, v in data.items():
        assert np.allclose(got[c], np.quantile(v, probs), rtol=1e-12), c
    assert got["none"] == (None,) * 6 and got["one"] == (1.0,) * 6


def test_quality_profile_correlations_by_pair(spark):
    rows = [(1.0, 2.0, None), (2.0, 4.1, 5.0), (3.0, 5.9, 1.0), (None, 8.0, 2.0), (5.0, None, 3.0), (6.0, 12.2, 9.0)]
    df = spark.createDataFrame(rows, "a double, b double, c double")
    got = {r["column"]: r for r in profile.quality_profile(df, ["a", "b", "c"], ["a", "b", "c"]).collect()}
    m = np.array([[np.nan if v is None else v for v in r] for r in rows])

    def corr(i, j):
        both = ~np.isnan(m[:, i]) & ~np.isnan(m[:, j])
        return np.corrcoef(m[both, i], m[both, j])[0, 1]

    assert got["a"]["corr_with"] == "b" and got["a"]["corr"] == pytest.approx(corr(0, 1))
    best = max((0, 1), key=lambda j: abs(corr(2, j)))
    assert got["c"]["corr_with"] == "ab"[best] and got["c"]["corr"] == pytest.approx(corr(2, best))
    assert got["a"]["q50"] == 3.0


def test_cumulative_share_over_ranges(spark, small_ranges):
    df = spark.range(5000).select((F.sqrt("id")).cast("int").alias("v"))
    got = [(r.v, r.n, r.cum_share) for r in profile.cumulative_share(df, "v").collect()]
    total = 0
    for v, n, share in sorted(got, key=lambda r: (-r[1], r[0])):
        total += n
        assert share == pytest.approx(total / 5000)


def test_window_drift_equals_the_grouped_drift(spark):
    """The distance of each window to a large reference, with ties, nulls and unseen values, and its verdict."""
    n = 4000
    base = spark.range(n).select(
        "id", F.when(F.col("id") % 11 == 0, None).otherwise(F.round(F.sin("id") * 50 + F.col("id") / 200, 1)).alias("v"),
        (F.exp(F.sin(F.col("id") * 7)) * 3).alias("u"), F.when(F.col("id") > 2500, F.col("id") % 6).otherwise(F.col("id") % 3).cast("double").alias("few"),
        F.concat(F.lit("c"), (F.col("id") * F.col("id")) % F.when(F.col("id") > 3000, 9).otherwise(5)).alias("k"))
    ref = base.where("id < 3000").withColumn("few", F.col("few") % 3)
    num, cat = ["v", "u", "few"], ["k"]
    out, sch = rolling.replay(ref, base, "id", num, cat, batch=130, window=900, min_new=300, min_window=500)
    tagged = rolling.check_windows(base, "id", sch, 0)
    want = drift.drift_table(ref, tagged, num, cat, group="check_id", regime="distance")
    counts = rolling.W.value_counts(ref, num, cat)
    got = rolling.W.windows_table(counts, base.withColumnRenamed("id", "__seq"), rolling.block_counts(base.withColumnRenamed("id", "__seq"), sch, ["few"], cat),
                                  rolling.checks_table(spark, sch), num, cat, lambda df: rolling.check_windows(df, "__seq", sch, 0))
    told = {(int(r.check_id), r.column): r for r in want.collect()}
    rows = got.collect()
    assert len(rows) == len(told) == 4 * sch.n_checks and sch.final_short
    for r in rows:
        w = told[r.check_id, r.column]
        assert (r.n_ref, r.n_cur, r.test, r.drifted) == (w.n_ref, w.n_cur, w.test, w.drifted)
        assert r.statistic == pytest.approx(w.statistic, abs=1e-9)
    verdict = {r.check_id: r.n_drifted for r in out.collect()}
    assert verdict == {c: sum(w.drifted for (k, _), w in told.items() if k == c) for c in range(sch.n_checks)}


def test_latest_table_rewrites_touched_partitions_only(spark):
    path = shared_path(spark, "test-latest")
    table = ST.LatestTable(spark, path, "k", "ts", parts=8)
    first = spark.range(200).select(F.col("id").alias("k"), F.lit(1).alias("ts"), F.lit("old").alias("v"))
    assert table.merge(first, 0) == set(range(8))
    one = spark.createDataFrame([(17, 2, "new")], "k long, ts int, v string")
    for _ in range(2):  # the second time as a replayed batch
        assert len(table.merge(one, 1)) == 1
        assert len(ST._list_dirs(spark, table._folder(1))) == 1
        assert sorted(table.manifest().values()) == [0] * 7 + [1]
        rows = {r.k: (r.ts, r.v) for r in table.read().collect()}
        assert len(rows) == 200 and rows.pop(17) == (2, "new") and set(rows.values()) == {(1, "old")}
    # a version whose manifest was not committed is not seen, and starts over
    ST.remove_path(spark, f"{table.manifests}/v={1:012d}/_SUCCESS")
    assert {r.v for r in table.read().collect()} == {"old"}
    table.merge(one, 1)
    # an empty batch changes nothing; folders that no manifest names go
    assert table.merge(one.limit(0), 2) == set()
    for version in range(3, 6):
        table.merge(first.withColumn("ts", F.lit(version)), version)
    assert {ST.os.path.basename(p) for p in ST._list_dirs(spark, table.data)} == {f"v={v:012d}" for v in (4, 5)}
    assert {r.ts for r in table.read().collect()} == {5}


def test_a_failing_log_does_not_stop_scoring(spark):
    base = shared_path(spark, "test-log")
    for i in range(4):
        spark.range(10 * i, 10 * i + 10).coalesce(1).write.mode("append").parquet(f"{base}/source")
    seen, failures = [], [True, True]

    def log(rows, path):
        seen.append(rows.count())
        if failures:
            failures.pop()
            raise OSError("no log")
        rows.write.mode("overwrite").parquet(path)

    stream = ST.file_stream(spark, f"{base}/source", spark.range(1).schema)
    ST.score_and_log(stream, lambda b: b.withColumn("score", F.col("id") / 40), f"{base}/scores", f"{base}/log", f"{base}/checkpoint", log)
    scores = sorted(map(tuple, ST.read_batches(spark, f"{base}/scores").collect()))
    assert [r[0] for r in scores] == list(range(40))
    assert sorted(map(tuple, ST.read_batches(spark, f"{base}/log").collect())) == scores
    assert len(seen) == 6  # four batches, two of them tried twice


def test_compiled_trees_score_like_the_model(spark, small_dir):
    """Spark ML, the column expressions and DuckDB give one probability; missing features go right."""
    li = read_table(spark, small_dir, "lineitem").select(
        F.col("l_quantity").cast("double").alias("q"), F.col("l_extendedprice").cast("double").alias("p"),
        F.when(F.col("l_partkey") % 9 == 0, None).otherwise(F.col("l_discount")).cast("double").alias("d"),
        F.when(F.col("l_partkey") % 7 == 0, float("nan")).otherwise(F.col("l_tax")).cast("double").alias("t"),
        ((F.col("l_quantity") * F.col("l_discount") > 1) | (F.col("l_tax") > 0.06)).cast("int").alias("y"))
    frame = li.toPandas()
    frame["id"] = range(len(frame))
    li = spark.createDataFrame(frame).withColumn("d", F.nanvl("d", F.lit(None).cast("double")))
    cols = ["q", "p", "d", "t"]
    model = ML.train_gbt(li.na.drop().where("not isnan(t)"), cols, "y", max_iter=6)  # NaN and nulls are met when scoring only
    ensemble = trees.export(model, cols)
    assert len(ensemble.trees) == 6 and ensemble.features() <= set(cols) and len(ensemble.features()) >= 2
    keys = ["id"]
    theirs = ML.score(model, li, keep=keys)
    ours = trees.score(ensemble, li, keep=keys)
    diff = evaluate.paired_diff(theirs, ours, keys, "probability", "probability", tolerance=1e-9).first()
    assert diff["n"] == li.count() and diff["passed"]
    assert theirs.select("prediction", *keys).exceptAll(ours.select("prediction", *keys)).count() == 0
    told = dict(duckdb.sql(f"SELECT id, {trees.probability_sql(ensemble)} FROM frame").fetchall())
    assert all(abs(told[r.id] - r.probability) < 1e-9 for r in theirs.collect())


def test_random_search_fits_the_same_model_once_and_scores_held_rows_only(spark, monkeypatch):
    """Draws without a penalty differ in nothing; a fold is scored from its own rows, and every row once a model."""
    from cohortwatch.operators import model as ML
    rows = [(float(i % 7), float(i % 5), int(i % 3 == 0), i % 2) for i in range(120)]
    df = spark.createDataFrame(rows, "a double, b double, y int, fold int")
    fitted, cut = [], []
    scores, lineage = ML.cross_scores, ML.cut_lineage
    monkeypatch.setattr(ML, "cross_scores", lambda *a: fitted.append((sorted(a[5]), a)) or scores(*a))
    monkeypatch.setattr(ML, "cut_lineage", lambda d: cut.append(lineage(d)) or cut[-1])
    table, _ = ML.random_search(df, ["a", "b"], "y", "fold", 2, {"regParam": [0.0], "elasticNetParam": [0.0, 0.5, 1.0], "maxIter": [4]}, n_iter=6)
    got = table.orderBy("draw").collect()
    assert [r["draw"] for r in got] == list(range(7)) and len({r["auc"] for r in got[1:]}) == 1
    assert fitted[0][0] == ["0", "1"]
    assert sorted(d.count() for d in cut[:3]) == [60, 60, 120]
    out = scores(*fitted[0][1])
    assert {(r["model"], r["fold"]): r["count"] for r in out.groupBy("model", "fold").count().collect()} == {(m, f): 60 for m in "01" for f in (0, 1)}
