"""Queries: point-in-time retrieval and feature views."""

from __future__ import annotations

from pyspark.sql import functions as F

from cohortwatch.functions.values import json_field
from cohortwatch.operators import asof as A
from cohortwatch.plans.fixtures import read_table
from cohortwatch.plans.registry import register

TTL_SECONDS = 3 * 86400
AS_OF_NOW = "2024-01-31 00:00:00"
# named feature sets (a "feature service" resolves to a projection)
FEATURE_SETS = {"user_activity": ["event_type", "value"], "user_value": ["value"]}

CLICKS = "SELECT event_id, user_id, ts, value FROM events WHERE event_type = 'click'"
PURCHASES = "SELECT event_id, user_id, ts, value FROM events WHERE event_type = 'purchase'"


def _clicks(spark, sf_dir):
    ev = read_table(spark, sf_dir, "events")
    return ev.filter(F.col("event_type") == "click").select("event_id", "user_id", "ts", "value")


def _purchases(spark, sf_dir):
    ev = read_table(spark, sf_dir, "events")
    return ev.filter(F.col("event_type") == "purchase").select(
        F.col("event_id").alias("p_event_id"), "user_id", F.col("ts").alias("p_ts"), F.col("value").alias("p_value"))


def _asof(spark, sf_dir):
    return A.asof_join(_clicks(spark, sf_dir), _purchases(spark, sf_dir), "user_id", "ts", "p_ts",
                       ["p_event_id", "p_value"], ttl_seconds=TTL_SECONDS, tie_breaker="p_event_id")


ASOF_SQL = f"""
SELECT c.event_id, c.user_id, c.ts, c.value,
  CASE WHEN p.ts >= c.ts - INTERVAL 3 DAY THEN p.ts END AS p_ts,
  CASE WHEN p.ts >= c.ts - INTERVAL 3 DAY THEN p.event_id END AS p_event_id,
  CASE WHEN p.ts >= c.ts - INTERVAL 3 DAY THEN p.value END AS p_value
FROM ({CLICKS}) c ASOF LEFT JOIN ({PURCHASES}) p ON c.user_id = p.user_id AND c.ts >= p.ts
"""


@register("asof_ttl", ASOF_SQL)
def q_asof_ttl(spark, sf_dir):
    return _asof(spark, sf_dir)


@register("ondemand_feature", f"""
SELECT event_id, p_value, value + p_value AS value_plus_purchase FROM ({ASOF_SQL})
""")
def q_ondemand_feature(spark, sf_dir):
    """On-demand feature: request value + retrieved stored feature."""
    j = _asof(spark, sf_dir)
    return j.select("event_id", "p_value", (F.col("value") + F.col("p_value")).alias("value_plus_purchase"))


@register("asof_now", f"""
WITH latest AS (
  SELECT user_id, ts, event_id, value FROM events
  WHERE event_type = 'purchase' AND ts <= TIMESTAMP '{AS_OF_NOW}'
    AND ts >= TIMESTAMP '{AS_OF_NOW}' - INTERVAL 3 DAY
  QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1)
SELECT u.user_id, l.ts AS p_ts, l.event_id AS p_event_id, l.value AS p_value
FROM (SELECT DISTINCT user_id FROM events) u LEFT JOIN latest l ON u.user_id = l.user_id
""")
def q_asof_now(spark, sf_dir):
    """Batch-scoring retrieval: every entity as of one late time."""
    ev = read_table(spark, sf_dir, "events")
    latest = A.latest_per_key(ev.filter(F.col("event_type") == "purchase"), "user_id", "ts",
                              ["event_id", "value"], as_of=AS_OF_NOW, ttl_seconds=TTL_SECONDS,
                              tie_breaker="event_id")
    users = ev.select("user_id").distinct()
    return A.lookup_latest(users, latest, "user_id").select(
        "user_id", F.col("ts").alias("p_ts"), F.col("event_id").alias("p_event_id"), F.col("value").alias("p_value"))


LATEST_SQL = """SELECT user_id, ts, event_id, event_type, value FROM events
  QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1"""


def _latest(spark, sf_dir):
    ev = read_table(spark, sf_dir, "events")
    return A.latest_per_key(ev, "user_id", "ts", ["event_id", "event_type", "value"], tie_breaker="event_id")


@register("latest_lookup", f"""
SELECT c.c_custkey, l.ts, l.event_id, l.event_type, l.value
FROM customer c LEFT JOIN ({LATEST_SQL}) l ON c.c_custkey = l.user_id
""")
def q_latest_lookup(spark, sf_dir):
    """Requests for every customer key; keys with no events get nulls."""
    req = read_table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("user_id"))
    out = A.lookup_latest(req, _latest(spark, sf_dir), "user_id")
    return out.select(F.col("user_id").alias("c_custkey"), "ts", "event_id", "event_type", "value")


@register("feature_set_select", f"SELECT user_id, event_type, value FROM ({LATEST_SQL})")
def q_feature_set_select(spark, sf_dir):
    return A.select_feature_set(_latest(spark, sf_dir), FEATURE_SETS, "user_activity", ["user_id"])


@register("json_map_columns", """
SELECT event_id,
  CAST(json_extract(props, '$.k') AS INT) AS k,
  CAST(json_extract(props, '$.k') AS INT) + 1 AS k_from_map,
  json_object('k', CAST(json_extract(props, '$.k') AS INT), 'type', event_type)::VARCHAR AS props_out
FROM events
""")
def q_json_map_columns(spark, sf_dir):
    """JSON decode/encode and map construction/lookup on a column."""
    ev = read_table(spark, sf_dir, "events")
    k = json_field("props", "$.k", "int")
    m = F.map_from_entries(F.array(F.struct(F.lit("k"), k + 1)))
    return ev.select("event_id", k.alias("k"), F.element_at(m, F.lit("k")).alias("k_from_map"),
                     F.to_json(F.struct(k.alias("k"), F.col("event_type").alias("type"))).alias("props_out"))
