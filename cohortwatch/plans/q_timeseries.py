"""Queries: metric samples, rates, quantiles, alert rules.

`events` rows are metric samples: name = event_type, value, ts; labels come from
user_id and the JSON props.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from cohortwatch import schemas as S
from cohortwatch.functions.values import clamp_max, status_band
from cohortwatch.operators import timeseries as TS
from cohortwatch.plans.fixtures import read_table
from cohortwatch.plans.registry import register

BOUNDS = [5.0, 10.0, 25.0, 50.0, 100.0, 250.0]
# ---------------------------------------------------------------------------
# Fixed values (names and hold times of the alert rules). The metrics and levels are those of
# the events fixture: (alert, metric, op, low, high, for_seconds).
RULES = [
    ("InferenceAPIDown", "signup", "eq", 0.0, None, 15),
    ("DriftedColumnsDetected", "click", "ge", 300.0, None, 15),
    ("DataDriftShareHigh", "view", "gt", 150.0, None, 15),
    ("DatasetDriftDetected", "error", "ge", 250.0, None, 15),
    ("PredictionDistributionShift", "purchase", "outside", 15.0, 40.0, 15),
    ("HighPredictionLatency", "view", "gt", 200.0, None, 30),
]
# ---------------------------------------------------------------------------
EXPECTED_SERIES = ["signup", "click", "purchase", "view", "error", "login", "logout", "refund"]


def r6(c):
    return F.round(c, 6)


def _events(spark, sf_dir):
    return read_table(spark, sf_dir, "events")


@register("counter_rate", """
SELECT event_id, event_type, round(inc_sum - COALESCE(first_inc, 0), 6) AS increase,
  round((inc_sum - COALESCE(first_inc, 0)) / 60.0, 6) AS rate
FROM (SELECT event_id, event_type, COALESCE(sum(inc) OVER w, 0) AS inc_sum, first(inc) OVER w AS first_inc
      FROM (SELECT *, CASE WHEN lag(value) OVER p IS NULL THEN NULL
                           WHEN value >= lag(value) OVER p THEN value - lag(value) OVER p ELSE value END AS inc
            FROM events WINDOW p AS (PARTITION BY event_type ORDER BY ts))
      WINDOW w AS (PARTITION BY event_type ORDER BY ts RANGE BETWEEN INTERVAL 60 SECONDS PRECEDING AND CURRENT ROW))
""")
def q_counter_rate(spark, sf_dir):
    samples = _events(spark, sf_dir).select("event_id", "event_type", "ts", "value")
    out = TS.counter_rate(samples, ["event_type"], "ts", "value", 60)
    return out.select("event_id", "event_type", r6("increase").alias("increase"), r6("rate").alias("rate"))


@register("throughput", """
SELECT event_id, event_type, count(*) OVER w AS n_window, round(count(*) OVER w / 60.0, 6) AS per_second
FROM events WINDOW w AS (PARTITION BY event_type ORDER BY ts RANGE BETWEEN INTERVAL 60 SECONDS PRECEDING AND CURRENT ROW)
""")
def q_throughput(spark, sf_dir):
    samples = _events(spark, sf_dir).select("event_id", "event_type", "ts")
    out = TS.window_count_rate(samples, ["event_type"], "ts", 60)
    return out.select("event_id", "event_type", "n_window", r6("per_second").alias("per_second"))


@register("sustained_alert", """
SELECT event_type, min(ts) AS start_ts, max(ts) AS end_ts, count(*) AS n_samples,
  (epoch_us(max(ts)) - epoch_us(min(ts))) / 1e6 AS held_seconds
FROM (SELECT *, sum(CASE WHEN value > 50 THEN 0 ELSE 1 END)
        OVER (PARTITION BY event_type ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS island
      FROM events)
WHERE value > 50 GROUP BY event_type, island
HAVING (epoch_us(max(ts)) - epoch_us(min(ts))) / 1e6 >= 3600
""")
def q_sustained_alert(spark, sf_dir):
    """value > 50 held for at least one hour, per series."""
    return TS.sustained_intervals(_events(spark, sf_dir), ["event_type"], "ts", F.col("value") > 50, 3600)


_BOUNDS_SQL = ", ".join(f"({b})" for b in BOUNDS) + ", ('inf'::DOUBLE)"
BUCKETS_SQL = f"""SELECT e.event_type, date_trunc('hour', e.ts) AS hour, l.le,
    count(*) FILTER (WHERE e.value <= l.le) AS count
  FROM events e, (VALUES {_BOUNDS_SQL}) l(le) GROUP BY ALL"""


def _quantile_sql(q):
    return f"""SELECT event_type, hour,
      CASE WHEN arg_min(le, le) FILTER (WHERE count >= rk) = 'inf'::DOUBLE THEN max(le) FILTER (WHERE le <> 'inf'::DOUBLE)
           ELSE arg_min(COALESCE(prev_le, 0) + (le - COALESCE(prev_le, 0)) * (rk - COALESCE(prev_n, 0))
                        / (count - COALESCE(prev_n, 0)), le) FILTER (WHERE count >= rk) END AS quantile
    FROM (SELECT *, lag(le) OVER w AS prev_le, lag(count) OVER w AS prev_n,
                 {q} * max(count) OVER (PARTITION BY event_type, hour) AS rk
          FROM b WINDOW w AS (PARTITION BY event_type, hour ORDER BY le))
    GROUP BY event_type, hour"""


@register("latency_buckets", f"SELECT event_type, le, count FROM ({BUCKETS_SQL.replace('date_trunc(' + chr(39) + 'hour' + chr(39) + ', e.ts) AS hour, ', '')})")
def q_latency_buckets(spark, sf_dir):
    """Cumulative bucket counts by upper bound."""
    return TS.cumulative_buckets(_events(spark, sf_dir), ["event_type"], "value", BOUNDS)


@register("hist_quantile", f"""
WITH b AS ({BUCKETS_SQL}), q50 AS ({_quantile_sql(0.5)}), q95 AS ({_quantile_sql(0.95)})
SELECT q50.event_type, q50.hour, round(q50.quantile, 6) AS p50, round(q95.quantile, 6) AS p95
FROM q50 JOIN q95 ON q50.event_type = q95.event_type AND q50.hour = q95.hour
""")
def q_hist_quantile(spark, sf_dir):
    """p50 and p95 per series and hour from cumulative buckets, linear inside a bucket."""
    ev = _events(spark, sf_dir).withColumn(
        "hour", F.date_trunc("hour", F.col("ts").cast("timestamp")).cast("timestamp_ntz"))
    b = TS.cumulative_buckets(ev, ["event_type", "hour"], "value", BOUNDS)
    p50 = TS.histogram_quantile(b, ["event_type", "hour"], 0.5).withColumnRenamed("quantile", "p50")
    p95 = TS.histogram_quantile(b, ["event_type", "hour"], 0.95).withColumnRenamed("quantile", "p95")
    return p50.join(p95, ["event_type", "hour"]).select("event_type", "hour", r6("p50").alias("p50"),
                                                        r6("p95").alias("p95"))


LATEST_SQL = """SELECT event_type, max(ts) AS ts, arg_max(value, ts) AS value FROM events
  WHERE value IS NOT NULL GROUP BY event_type"""


@register("latest_gauge", LATEST_SQL)
def q_latest_gauge(spark, sf_dir):
    return TS.latest_value(_events(spark, sf_dir), ["event_type"], "ts", "value")


def _rule_sql():
    vals = ", ".join(f"('{a}', '{m}', '{op}', {lo}, {'NULL' if hi is None else hi}, {f})" for a, m, op, lo, hi, f in RULES)
    return f"SELECT * FROM (VALUES {vals}) r(alert, metric, op, lo, hi, for_seconds)"


@register("alert_rules", f"""
WITH r AS ({_rule_sql()}),
s AS (SELECT r.alert, r.for_seconds, e.event_type, e.ts,
        CASE r.op WHEN 'eq' THEN e.value = r.lo WHEN 'ge' THEN e.value >= r.lo WHEN 'gt' THEN e.value > r.lo
                  WHEN 'outside' THEN e.value < r.lo OR e.value > r.hi END AS ok
      FROM events e JOIN r ON e.event_type = r.metric)
SELECT alert, for_seconds, event_type, min(ts) AS start_ts, max(ts) AS end_ts, count(*) AS n_samples,
  (epoch_us(max(ts)) - epoch_us(min(ts))) / 1e6 AS held_seconds
FROM (SELECT *, sum(CASE WHEN ok THEN 0 ELSE 1 END) OVER (PARTITION BY alert, for_seconds, event_type ORDER BY ts
        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS island FROM s)
WHERE ok GROUP BY alert, for_seconds, event_type, island
HAVING (epoch_us(max(ts)) - epoch_us(min(ts))) / 1e6 >= for_seconds
""")
def q_alert_rules(spark, sf_dir):
    """Rules as a table (fixed six rows, broadcast), condition per sample, then held-for intervals."""
    rules = spark.createDataFrame(RULES, "alert string, metric string, op string, lo double, hi double, for_seconds int")
    s = _events(spark, sf_dir).join(F.broadcast(rules), F.col("event_type") == F.col("metric"))
    v, lo, hi = F.col("value"), F.col("lo"), F.col("hi")
    ok = (F.when(F.col("op") == "eq", v == lo).when(F.col("op") == "ge", v >= lo).when(F.col("op") == "gt", v > lo)
          .when(F.col("op") == "outside", TS.outside_band(v, lo, hi)))
    return TS.sustained_intervals(s, ["alert", "for_seconds", "event_type"], "ts", ok, "for_seconds")


HEALTH_SQL = """
SELECT user_id, a, b, c, LEAST(a + b + c, 1) AS health,
  CASE WHEN LEAST(a + b + c, 1) = 0 THEN 'HEALTHY' ELSE 'DRIFT DETECTED' END AS status,
  CASE WHEN ratio < 0.15 THEN 'low' WHEN ratio < 0.4 THEN 'normal' ELSE 'high' END AS ratio_band
FROM (SELECT user_id,
        CASE WHEN max(CASE WHEN event_type = 'error' THEN value END) > 300 THEN 1 ELSE 0 END AS a,
        CASE WHEN max(CASE WHEN event_type = 'click' THEN value END) >= 300 THEN 1 ELSE 0 END AS b,
        CASE WHEN max(CASE WHEN event_type = 'view' THEN value END) / 1000.0 > 0.15 THEN 1 ELSE 0 END AS c,
        COALESCE(max(CASE WHEN event_type = 'purchase' THEN value END), 0) / 1000.0 AS ratio
      FROM (SELECT user_id, event_type, arg_max(value, ts) AS value FROM events WHERE value IS NOT NULL
            GROUP BY user_id, event_type)
      GROUP BY user_id)
"""


@register("composite_health", HEALTH_SQL)
def q_composite_health(spark, sf_dir):
    """Latest value per (user, metric) -> clamp(a + (b >= x) + (c > y), 1) and status text."""
    latest = TS.latest_value(_events(spark, sf_dir), ["user_id", "event_type"], "ts", "value")

    def metric(name):
        return F.max(F.when(F.col("event_type") == name, F.col("value")))

    wide = latest.groupBy("user_id").agg(
        (metric("error") > 300).cast("int").alias("a"), (metric("click") >= 300).cast("int").alias("b"),
        (metric("view") / 1000.0 > 0.15).cast("int").alias("c"),
        (F.coalesce(metric("purchase"), F.lit(0.0)) / 1000.0).alias("ratio"))
    wide = wide.select("user_id", F.coalesce("a", F.lit(0)).alias("a"), F.coalesce("b", F.lit(0)).alias("b"),
                       F.coalesce("c", F.lit(0)).alias("c"), "ratio")
    health = clamp_max(F.col("a") + F.col("b") + F.col("c"), 1)
    return wide.select("user_id", "a", "b", "c", health.alias("health"),
                       F.when(health == 0, "HEALTHY").otherwise("DRIFT DETECTED").alias("status"),
                       status_band("ratio", [(0.15, "low"), (0.4, "normal")], "high").alias("ratio_band"))


@register("baseline_delta", f"""
SELECT date_trunc('hour', ts) AS hour, round(avg(CASE WHEN value > 50 THEN 1.0 ELSE 0.0 END), 6) AS ratio,
  CAST({S.BASELINE_POSITIVE_RATIO} AS DOUBLE) AS baseline,
  round(avg(CASE WHEN value > 50 THEN 1.0 ELSE 0.0 END) - {S.BASELINE_POSITIVE_RATIO}, 6) AS delta
FROM events GROUP BY 1
""")
def q_baseline_delta(spark, sf_dir):
    """Hourly ratio series against a constant reference line."""
    ev = _events(spark, sf_dir)
    hourly = ev.groupBy(F.date_trunc("hour", F.col("ts").cast("timestamp")).cast("timestamp_ntz").alias("hour")).agg(
        F.avg(F.when(F.col("value") > 50, 1.0).otherwise(0.0)).alias("ratio"))
    base = F.lit(S.BASELINE_POSITIVE_RATIO)
    return hourly.select("hour", r6("ratio").alias("ratio"), base.alias("baseline"), r6(F.col("ratio") - base).alias("delta"))


@register("metric_labels", """
SELECT event_id, event_type AS type_label, json_extract_string(props, '$.k') AS k_label,
  CAST(user_id AS VARCHAR) AS user_label
FROM events
""")
def q_metric_labels(spark, sf_dir):
    """Labels map per sample -> label columns."""
    ev = _events(spark, sf_dir)
    labels = F.map_concat(F.create_map(F.lit("event_type"), F.col("event_type"), F.lit("user"),
                                       F.col("user_id").cast("string")),
                          F.from_json("props", "map<string,string>"))
    return ev.select("event_id", F.element_at(labels, F.lit("event_type")).alias("type_label"),
                     F.element_at(labels, F.lit("k")).alias("k_label"),
                     F.element_at(labels, F.lit("user")).alias("user_label"))


@register("guarded_match", """
WITH iv AS (SELECT user_id, event_type, to_timestamp(floor(epoch_us(ts) / 3600000000) * 3600) AS eval_ts,
                   arg_max(value, ts) AS value FROM events GROUP BY ALL)
SELECT a.user_id, a.eval_ts, a.value FROM iv a
WHERE a.event_type = 'purchase' AND (a.value > 400 OR a.value < 15)
  AND EXISTS (SELECT 1 FROM iv b WHERE b.event_type = 'view' AND b.value > 0
              AND b.user_id = a.user_id AND b.eval_ts = a.eval_ts)
""")
def q_guarded_match(spark, sf_dir):
    """Out-of-band purchase value guarded by a positive view sample with equal labels."""
    iv = TS.instant_vector(_events(spark, sf_dir), ["user_id", "event_type"], "ts", "value", 3600)
    a = iv.filter((F.col("event_type") == "purchase") & TS.outside_band(F.col("value"), 15.0, 400.0))
    b = iv.filter((F.col("event_type") == "view") & (F.col("value") > 0)).select("user_id", "eval_ts")
    out = TS.guarded_match(a, b, ["user_id", "eval_ts"])
    return out.select("user_id", F.col("eval_ts").cast("timestamp_ntz").alias("eval_ts"), "value")


@register("required_series", f"""
SELECT name AS metric_name FROM (VALUES {", ".join(f"('{n}')" for n in EXPECTED_SERIES)}) t(name)
WHERE name NOT IN (SELECT DISTINCT event_type FROM events WHERE event_type IS NOT NULL)
""")
def q_required_series(spark, sf_dir):
    """Expected series names that never appear."""
    expected = spark.createDataFrame([(n,) for n in EXPECTED_SERIES], "metric_name string")
    observed = _events(spark, sf_dir).select(F.col("event_type").alias("metric_name"))
    return TS.missing_series(expected, observed, "metric_name")
