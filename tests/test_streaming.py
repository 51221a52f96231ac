"""Live rolling monitor vs closed-form replay (T05), and state rules."""

from pyspark.sql import functions as F

from cohortwatch.plans.fixtures import read_table
from cohortwatch.session import shared_path
from cohortwatch.streaming import rolling as R
from cohortwatch.streaming.monitor import RollingDriftMonitor

W, NEW, MINW, BATCH = 300, 100, 200, 50


def test_schedule_closed_form():
    sch = R.schedule(10000, 300, 3000, 600, 2000)
    assert (sch.first, sch.step, sch.n_regular, sch.final_short) == (7, 2, 14, False)
    sch = R.schedule(1000, 300, 3000, 600, 2000)      # buffer never reaches 2000 rows
    assert sch.n_checks == 0
    sch = R.schedule(1150, 100, 500, 250, 200)         # short last batch (50 rows) completes 250 new rows
    assert (sch.first, sch.n_regular, sch.final_short) == (3, 3, True)


def test_monitor_matches_replay(spark, small_dir):
    ev = read_table(spark, small_dir, "events").select("event_id", "value", "event_type")
    ref = ev.filter(F.col("event_id") % 3 == 0)
    mon = RollingDriftMonitor(ref, ["value"], ["event_type"], shared_path(spark, "test-monitor"), "event_id",
                              W, NEW, MINW)
    n = ev.count()
    for b in range(-(-n // BATCH)):
        mon(ev.filter((F.col("event_id") >= b * BATCH) & (F.col("event_id") < (b + 1) * BATCH)), b)
    live = sorted((r.rows_seen, r.n_drifted, r.dataset_drift) for r in mon.verdicts(spark).collect())
    replay, _ = R.replay(ref, ev, "event_id", ["value"], ["event_type"], batch=BATCH, window=W, min_new=NEW,
                         min_window=MINW)
    expect = sorted((r.end_row, r.n_drifted, r.dataset_drift) for r in replay.collect())
    assert live == expect and len(live) > 5
    states = {r.batch_id: r.state for r in mon.states(spark).collect()}
    assert states[0] == "warming up" and states[max(states)] in ("healthy", "drift detected")


def test_monitor_replays_count_once(spark, small_dir):
    """A batch that failed after any of its writes is run again and changes nothing else."""
    from cohortwatch.streaming.stream import batch_path, path_exists, remove_path

    ev = read_table(spark, small_dir, "events").select("event_id", "value", "event_type")
    ref = ev.filter(F.col("event_id") % 3 == 0)
    once, again = (RollingDriftMonitor(ref, ["value"], ["event_type"], shared_path(spark, "test-replay"), "event_id", W, NEW, MINW)
                   for _ in range(2))
    for b in range(7):
        rows = ev.filter((F.col("event_id") >= b * BATCH) & (F.col("event_id") < (b + 1) * BATCH))
        once(rows, b)
        again(rows, b)
        if b % 2:  # the control row was lost: the batch is not final
            remove_path(spark, f"{again.folder}/control/v={b:08d}/_SUCCESS")
            again(rows, b)
        again(rows, b)
    key = lambda r: (r.batch_id, r.rows_seen, r.n_drifted, r.drifted_columns)
    assert sorted(map(key, once.verdicts(spark).collect())) == sorted(map(key, again.verdicts(spark).collect()))
    assert sorted(map(tuple, once.states(spark).collect())) == sorted(map(tuple, again.states(spark).collect()))
    assert not path_exists(spark, batch_path(f"{once.folder}/buffer", 0))  # out of reach of any window


def test_batches_overwrite_their_own_folder(spark):
    """Gauges, history and latest rows after a replayed batch, and ties of equal times."""
    from cohortwatch.streaming import stream as ST

    class Batches:
        """Stands for a stream: runs the batch function on each batch, and on the second one twice."""

    rows = [spark.createDataFrame([(1, 10, "a"), (2, 10, "b"), (2, 10, "c")], "k int, ts int, v string"),
            spark.createDataFrame([(1, 11, "d"), (3, 11, "e")], "k int, ts int, v string")]
    done = []

    def each(stream, fn, checkpoint, mode="append"):
        for b in (0, 1, 1):
            fn(rows[b], b)
        done.append(checkpoint)

    real, ST.foreach_batch = ST.foreach_batch, each
    try:
        base = shared_path(spark, "test-batches")
        ST.push_latest(Batches(), "k", "ts", f"{base}/history", f"{base}/latest", "x")
        ST.batch_gauges(Batches(), "ts", "k", f"{base}/gauges", "y")
    finally:
        ST.foreach_batch = real
    assert done == ["x", "y"]
    assert ST.read_batches(spark, f"{base}/history").count() == 5
    latest = sorted(map(tuple, ST.LatestTable(spark, f"{base}/latest", "k", "ts").read().collect()))
    assert latest[0] == (1, 11, "d") and latest[1] in ((2, 10, "b"), (2, 10, "c")) and latest[2:] == [(3, 11, "e")]
    assert ST.read_batches(spark, f"{base}/gauges").count() == 4
