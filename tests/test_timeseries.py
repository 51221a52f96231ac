"""Hand-made series for counter resets and histogram quantiles."""

import datetime as dt

from pyspark.sql import functions as F

from cohortwatch.operators import timeseries as TS


def test_counter_increase_is_reset_aware(spark):
    t0 = dt.datetime(2024, 1, 1, 0, 0, 0)
    rows = [(i, "c", t0 + dt.timedelta(seconds=10 * i), v) for i, v in enumerate([1.0, 3.0, 2.0, 5.0])]
    df = spark.createDataFrame(rows, "id int, name string, ts timestamp_ntz, value double")
    got = {r.id: r.increase for r in TS.counter_rate(df, ["name"], "ts", "value", 60).collect()}
    # pairs inside the window: 1->3 (+2), 3->2 is a reset (+2), 2->5 (+3)
    assert got == {0: 0.0, 1: 2.0, 2: 4.0, 3: 7.0}


def test_histogram_quantile_linear_and_inf_bucket(spark):
    rows = [("a", 0.1, 10), ("a", 0.5, 30), ("a", 1.0, 40), ("a", float("inf"), 40),
            ("b", 0.1, 0), ("b", 0.5, 0), ("b", 1.0, 1), ("b", float("inf"), 100)]
    b = spark.createDataFrame(rows, "s string, le double, count long")
    got = {r.s: r.quantile for r in TS.histogram_quantile(b, ["s"], 0.5).collect()}
    # a: rank 20 lies in (0.1, 0.5] between counts 10 and 30 -> 0.1 + 0.4 * 10/20
    assert abs(got["a"] - 0.3) < 1e-12
    # b: rank 50 falls in the +Inf bucket -> largest finite bound
    assert got["b"] == 1.0


def test_long_series_equal_short_ones_by_hand(spark, monkeypatch):
    """Increase and count over ranges of few rows: equal times, equal samples, bursts over many ranges, null times, values and names."""
    import random
    random.seed(5)
    rows, t = [], 0.0
    for i in range(300):
        t += random.choice([0.0, 0.0, 0.5, 1.0, 7.0, 59.0, 61.0, 400.0]) if i % 100 < 60 else 0.01
        name = random.choice(["a", "a", "a", "b", None])
        rows.append((i, name, None if i % 37 == 0 else t, None if i % 41 == 0 else float(random.randrange(6))))
    df = spark.createDataFrame(rows, "id long, name string, s double, value double").withColumn("ts", F.timestamp_micros((F.col("s") * 1e6).cast("long")))
    df = df.drop("s").repartition(7)

    want = {}
    for name in ("a", "b", None):
        low = float("-inf")
        mine = sorted((r for r in rows if r[1] == name), key=lambda r: (low if r[2] is None else r[2], low if r[3] is None else r[3]))
        step = [0.0] + [0.0 if p[3] is None or c[3] is None else c[3] - p[3] if c[3] >= p[3] else c[3] for p, c in zip(mine, mine[1:])]
        for r in mine:
            held = [i for i, x in enumerate(mine) if (x[2] is None if r[2] is None else x[2] is not None and round(r[2] * 1e6) - 60_000_000 <= round(x[2] * 1e6) <= round(r[2] * 1e6))]
            want[r[0]] = (round(sum(step[i] for i in held[1:]), 6), len(held))

    cut = []
    real = TS.cut_lineage
    monkeypatch.setattr(TS, "FRAME_ROWS", 0)
    monkeypatch.setattr(TS.scan, "RANGE_ROWS", 15)
    monkeypatch.setattr(TS, "cut_lineage", lambda d: cut.append(1) or real(d))
    inc = {r["id"]: round(r["increase"], 6) for r in TS.counter_rate(df, ["name"], "ts", "value", 60).collect()}
    n = {r["id"]: r["n_window"] for r in TS.window_count_rate(df, ["name"], "ts", 60).collect()}
    assert {k: (inc[k], n[k]) for k in want} == want and len(inc) == len(n) == len(rows)
    assert len(cut) == 4  # the rows once, and one row a range
