"""Queries: count-based rolling drift replay and monitor states.

`events` in event_id order are the served rows, in batches of 300; all of them are
the drift reference too.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from cohortwatch import schemas as S
from cohortwatch.plans.drift_sql import drift_ctes, verdict_sql
from cohortwatch.plans.fixtures import read_table
from cohortwatch.plans.registry import register, with_ctes
from cohortwatch.streaming import rolling as R

BATCH = 300
W, NEW, MINW = S.ROLLING_WINDOW_ROWS, S.ROLLING_MIN_NEW_ROWS, S.ROLLING_MIN_WINDOW_ROWS
NUM, CAT = ["value"], ["event_type"]


def _replay(spark, sf_dir):
    ev = read_table(spark, sf_dir, "events").select("event_id", "value", "event_type")
    return R.replay(ev, ev, "event_id", NUM, CAT, batch=BATCH, window=W, min_new=NEW, min_window=MINW)


_STEP = -(-NEW // BATCH)
_K0 = max(_STEP, -(-MINW // BATCH))
SCHED_SQL = f"""
SELECT n, lo, full_b, nb, j_reg, short_rows,
  short_rows > 0 AND ((full_b - CASE WHEN j_reg > 0 THEN {_K0} + (j_reg - 1) * {_STEP} ELSE 0 END) * {BATCH}
                      + short_rows) >= {NEW} AND LEAST(n, {W}) >= {MINW} AS final_short
FROM (SELECT n, lo, full_b, CAST(ceil(n / {BATCH}) AS BIGINT) AS nb, n - full_b * {BATCH} AS short_rows,
        CASE WHEN {_K0} > full_b THEN 0 ELSE (full_b - {_K0}) // {_STEP} + 1 END AS j_reg
      FROM (SELECT count(*) AS n, min(event_id) AS lo, count(*) // {BATCH} AS full_b FROM events))
"""
CHECKS_SQL = f"""
SELECT range AS check_id, {_K0} + range * {_STEP} AS batch_index, ({_K0} + range * {_STEP}) * {BATCH} AS end_row
FROM sched, range(0, (SELECT j_reg FROM sched))
UNION ALL SELECT j_reg, nb, n FROM sched WHERE final_short
"""
ROLL_CTES = dict(
    sched=SCHED_SQL, checks=CHECKS_SQL,
    ref="SELECT event_id, value, event_type FROM events",
    cur=f"""SELECT e.event_id, e.value, e.event_type, c.check_id FROM events e, sched s, checks c
            WHERE e.event_id - s.lo >= c.end_row - {W} AND e.event_id - s.lo < c.end_row""",
    **drift_ctes("ref", "cur", NUM, CAT, "check_id"),
    verdict=verdict_sql(),
    sizes="SELECT check_id, count(*) AS n_window FROM cur GROUP BY check_id",
    out="""SELECT c.check_id, c.batch_index, c.end_row, s.n_window, v.n_columns, v.n_drifted,
             round(v.drift_share, 6) AS drift_share, v.dataset_drift
           FROM checks c JOIN sizes s ON c.check_id = s.check_id JOIN verdict v ON CAST(v.g AS BIGINT) = c.check_id""",
)


@register("rolling_drift_replay", with_ctes("SELECT * FROM out", **ROLL_CTES))
def q_rolling_drift_replay(spark, sf_dir):
    """Checks at 2100 rows then every 600, each on the last 3000 rows, one grouped drift job."""
    out, _ = _replay(spark, sf_dir)
    return out.select("check_id", "batch_index", "end_row", "n_window", "n_columns", "n_drifted",
                      F.round("drift_share", 6).alias("drift_share"), "dataset_drift")


def _state_sql(enabled):
    told = "'disabled'" if not enabled else """CASE WHEN o.check_id IS NULL THEN 'warming up' WHEN o.dataset_drift THEN 'drift detected' ELSE 'healthy' END"""
    return with_ctes(f"""
SELECT b.range AS batch_index, LEAST(b.range * {BATCH}, s.n) AS rows_seen,
  LEAST(LEAST(b.range * {BATCH}, s.n), {W}) AS buffered,
  LEAST(b.range * {BATCH}, s.n) - COALESCE(o.end_row, 0) AS rows_since_check, o.check_id AS last_check,
  {told} AS state
FROM sched s, range(1, (SELECT nb FROM sched) + 1) b
LEFT JOIN out o ON o.check_id = (SELECT max(check_id) FROM checks c WHERE c.batch_index <= b.range)
""", **ROLL_CTES)


@register("drift_state", _state_sql(True))
def q_drift_state(spark, sf_dir):
    """Monitor state after every batch."""
    out, sch = _replay(spark, sf_dir)
    return R.states(spark, out, sch)


@register("drift_state_disabled", _state_sql(False))
def q_drift_state_disabled(spark, sf_dir):
    """A monitor that is switched off says so after every batch; its counters go on."""
    out, sch = _replay(spark, sf_dir)
    return R.states(spark, out, sch, enabled=False)
