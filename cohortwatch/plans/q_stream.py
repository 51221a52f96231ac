"""Queries: streams over `events` staged one file per day.

Each query stages the whole table into the shared folder, runs the stream with
``availableNow`` (one file per micro-batch), and returns what the sink holds,
so the streamed answer is compared with the batch (SQL) answer.
"""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortwatch import schemas as S
from cohortwatch.operators import timeseries as TS
from cohortwatch.plans.drift_sql import drift_ctes, verdict_sql
from cohortwatch.plans.fixtures import read_table
from cohortwatch.plans.registry import register, with_ctes
from cohortwatch.streaming import stream as ST
from cohortwatch.streaming.monitor import RollingDriftMonitor

# key-hash partitions of the latest tables here: a handful of users
LATEST_PARTS = 4
END_1 = "2024-01-15 00:00:00"
END_2 = "2024-01-31 23:59:59"


def _staged(spark, sf_dir, name, files_per_batch=1):
    dirs = ST.new_stream_dirs(spark, name)
    ev = read_table(spark, sf_dir, "events")
    ST.stage_by_day(ev, "ts", dirs["source"])
    schema = T.StructType(ev.schema.fields + [T.StructField("day", T.DateType())])
    return dirs, ST.file_stream(spark, dirs["source"], schema, files_per_batch=files_per_batch)


def _score(df):
    return df.withColumns({"score": F.least(F.col("value") / 100.0, F.lit(1.0)),
                           "prediction": (F.col("value") >= 50).cast("int")})


@register("stream_score", """
SELECT event_id, round(LEAST(value / 100.0, 1.0), 6) AS score, CASE WHEN value >= 50 THEN 1 ELSE 0 END AS prediction
FROM events
""")
def q_stream_score(spark, sf_dir):
    """Score every micro-batch, append to a file sink."""
    dirs, stream = _staged(spark, sf_dir, "score")
    ST.append_to_files(_score(stream).select("event_id", "score", "prediction"), dirs["sink"], dirs["checkpoint"])
    out = spark.read.parquet(dirs["sink"])
    return out.select("event_id", F.round("score", 6).alias("score"), "prediction")


@register("stream_totals", """
SELECT event_type, count(*) AS n, round(sum(value), 6) AS total FROM events GROUP BY event_type
""")
def q_stream_totals(spark, sf_dir):
    """Running count and sum per type, complete mode; the last version is the answer."""
    dirs, stream = _staged(spark, sf_dir, "totals")
    ST.running_totals(stream, ["event_type"], "value", dirs["sink"], dirs["checkpoint"])
    out = ST.latest_version(spark, dirs["sink"])
    return out.select("event_type", "n", F.round("total", 6).alias("total"))


def _gauges(spark, sf_dir, name):
    dirs, stream = _staged(spark, sf_dir, name)
    ST.batch_gauges(_score(stream), "ts", "prediction", dirs["sink"], dirs["checkpoint"],
                    labels={"model_version": "rule-1"})
    return ST.read_batches(spark, dirs["sink"])


@register("stream_batch_ratio", """
SELECT max(ts) AS ts, CAST(count(*) AS DOUBLE) AS rows_scored,
  round(avg(CASE WHEN value >= 50 THEN 1.0 ELSE 0.0 END), 6) AS predicted_positive_ratio
FROM events GROUP BY CAST(ts AS DATE)
""")
def q_stream_batch_ratio(spark, sf_dir):
    """The positive ratio of every micro-batch (one day per batch) as gauge samples."""
    s = _gauges(spark, sf_dir, "ratio")
    wide = s.groupBy("ts").agg(F.max(F.when(F.col("name") == "rows_scored", F.col("value"))).alias("rows_scored"),
                               F.max(F.when(F.col("name") == "predicted_positive_ratio", F.col("value")))
                               .alias("predicted_positive_ratio"))
    return wide.select(F.col("ts").cast("timestamp_ntz").alias("ts"), "rows_scored",
                       F.round("predicted_positive_ratio", 6).alias("predicted_positive_ratio"))


@register("stream_publish", """
SELECT 'predicted_positive_ratio' AS name,
  round((SELECT avg(CASE WHEN value >= 50 THEN 1.0 ELSE 0.0 END) FROM events
         WHERE CAST(ts AS DATE) = (SELECT max(CAST(ts AS DATE)) FROM events)), 6) AS value,
  'rule-1' AS model_version
UNION ALL SELECT 'rows_scored_total', CAST(count(*) AS DOUBLE), 'rule-1' FROM events
""")
def q_stream_publish(spark, sf_dir):
    """Published samples -> current gauge (last by time) and counter total, label as column."""
    s = _gauges(spark, sf_dir, "publish")
    latest = TS.latest_value(s.filter(F.col("name") == "predicted_positive_ratio"), ["name"], "ts", "value")
    total = s.filter(F.col("name") == "rows_scored").agg(F.sum("value").alias("value")).select(
        F.lit("rows_scored_total").alias("name"), "value")
    label = s.select(F.element_at("labels", F.lit("model_version")).alias("model_version")).distinct()
    out = latest.select("name", F.round("value", 6).alias("value")).unionByName(total)
    return out.withColumn("model_version", label.scalar())


LATEST_SQL = """SELECT user_id, ts, event_id, event_type, value FROM events {where}
  QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC) = 1"""


@register("stream_push_latest", LATEST_SQL.format(where=""))
def q_stream_push_latest(spark, sf_dir):
    """Every batch appended to history and merged into a latest-per-key table."""
    dirs, stream = _staged(spark, sf_dir, "push")
    ST.push_latest(stream.drop("day").select("user_id", "ts", "event_id", "event_type", "value"), "user_id", "ts",
                   dirs["history"], dirs["latest"], dirs["checkpoint"], parts=LATEST_PARTS)
    return ST.LatestTable(spark, dirs["latest"], "user_id", "ts").read().select("user_id", "ts", "event_id", "event_type", "value")


@register("stream_incremental", LATEST_SQL.format(where=f"WHERE ts <= TIMESTAMP '{END_2}'"))
def q_stream_incremental(spark, sf_dir):
    """Two incremental runs (to mid-month, then month end); each takes only rows after the low mark."""
    dirs = ST.new_stream_dirs(spark, "incremental")
    ev = read_table(spark, sf_dir, "events").select("user_id", "ts", "event_id", "event_type", "value")
    for end in (END_1, END_2):
        ST.materialize_incremental(spark, ev, "user_id", "ts", end, dirs["control"], dirs["latest"], parts=LATEST_PARTS)
    return ST.LatestTable(spark, dirs["latest"], "user_id", "ts").read().select("user_id", "ts", "event_id", "event_type", "value")


@register("stream_append_log", "SELECT event_id, event_type, value, CASE WHEN value >= 50 THEN 1 ELSE 0 END AS "
                               "prediction FROM events")
def q_stream_append_log(spark, sf_dir):
    """Audit log of scored rows; a second run on the same checkpoint adds nothing."""
    dirs, stream = _staged(spark, sf_dir, "log")
    scored = _score(stream).select("event_id", "event_type", "value", "prediction")
    for _ in range(2):
        ST.append_to_files(scored, dirs["sink"], dirs["checkpoint"])
    return spark.read.parquet(dirs["sink"])


@register("stream_score_and_log", "SELECT event_id, CASE WHEN value >= 50 THEN 1 ELSE 0 END AS prediction, true AS logged FROM events")
def q_stream_score_and_log(spark, sf_dir):
    """Scores and their audit log as two sinks; the log fails for the first two batches and catches up."""
    dirs, stream = _staged(spark, sf_dir, "both", files_per_batch=5)
    failures = iter(range(2))

    def log(rows, path):
        if next(failures, None) is not None:
            raise OSError("log sink not available")
        rows.write.mode("overwrite").parquet(path)

    ST.score_and_log(stream, lambda b: _score(b).select("event_id", "prediction"), dirs["sink"], dirs["history"], dirs["checkpoint"], log)
    logged = ST.read_batches(spark, dirs["history"]).select("event_id", F.lit(True).alias("logged"))
    return ST.read_batches(spark, dirs["sink"]).join(logged, "event_id", "left").select("event_id", "prediction", F.coalesce("logged", F.lit(False)).alias("logged"))


FILES_PER_CHECK_BATCH = 3
LIVE_CTES = dict(
    days="SELECT day, row_number() OVER (ORDER BY day) - 1 AS di FROM (SELECT DISTINCT CAST(ts AS DATE) AS day FROM events)",
    arrived=f"""SELECT e.event_id, e.value, e.event_type, d.di // {FILES_PER_CHECK_BATCH} AS batch_id,
                row_number() OVER (ORDER BY d.di // {FILES_PER_CHECK_BATCH}, e.event_id) - 1 AS seq
                FROM events e JOIN days d ON CAST(e.ts AS DATE) = d.day""",
    sizes="SELECT batch_id, n, sum(n) OVER (ORDER BY batch_id) AS seen FROM (SELECT batch_id, count(*) AS n FROM arrived GROUP BY batch_id)",
    run=f"""SELECT batch_id, seen, n AS since, n >= {S.ROLLING_MIN_NEW_ROWS} AND LEAST(seen, {S.ROLLING_WINDOW_ROWS}) >= {S.ROLLING_MIN_WINDOW_ROWS} AS due
            FROM sizes WHERE batch_id = 0
            UNION ALL SELECT s.batch_id, s.seen, s.n + CASE WHEN r.due THEN 0 ELSE r.since END,
              s.n + CASE WHEN r.due THEN 0 ELSE r.since END >= {S.ROLLING_MIN_NEW_ROWS} AND LEAST(s.seen, {S.ROLLING_WINDOW_ROWS}) >= {S.ROLLING_MIN_WINDOW_ROWS}
            FROM run r JOIN sizes s ON s.batch_id = r.batch_id + 1""",
    ref="SELECT event_id, value, event_type FROM events",
    cur=f"""SELECT a.event_id, a.value, a.event_type, r.batch_id AS check_id FROM arrived a
            JOIN run r ON r.due AND a.seq >= r.seen - {S.ROLLING_WINDOW_ROWS} AND a.seq < r.seen""",
    **drift_ctes("ref", "cur", ["value"], ["event_type"], "check_id"),
    verdict=verdict_sql(),
)


@register("stream_rolling_drift", with_ctes("""
SELECT r.batch_id, CAST(r.seen AS BIGINT) AS rows_seen, CAST(CASE WHEN r.due THEN 0 ELSE r.since END AS BIGINT) AS rows_since, r.due AS checked,
  CASE WHEN v.dataset_drift IS NULL THEN 'warming up' WHEN v.dataset_drift THEN 'drift detected' ELSE 'healthy' END AS state
FROM run r LEFT JOIN verdict v ON CAST(v.g AS BIGINT) = (SELECT max(c.batch_id) FROM run c WHERE c.due AND c.batch_id <= r.batch_id)
""", **LIVE_CTES).replace("WITH ", "WITH RECURSIVE ", 1))
def q_stream_rolling_drift(spark, sf_dir):
    """T05, T06 live: foreachBatch monitor over micro-batches of three day files, against all events; state after every batch."""
    dirs, stream = _staged(spark, sf_dir, "rolling", files_per_batch=FILES_PER_CHECK_BATCH)
    ref = read_table(spark, sf_dir, "events").select("event_id", "value", "event_type")
    mon = RollingDriftMonitor(ref, ["value"], ["event_type"], dirs["sink"], "event_id", S.ROLLING_WINDOW_ROWS,
                              S.ROLLING_MIN_NEW_ROWS, S.ROLLING_MIN_WINDOW_ROWS)
    ST.foreach_batch(stream.select("event_id", "value", "event_type"), mon, dirs["checkpoint"])
    return mon.states(spark)
