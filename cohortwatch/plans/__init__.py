"""Composed query plans over the test fixtures; importing registers every key."""

from cohortwatch.plans import pipeline, q_asof, q_clean, q_drift, q_encode, q_eval, q_io, q_model, q_profile, q_rolling, q_scenario, q_split, q_stream, q_timeseries  # noqa: F401
from cohortwatch.plans.registry import ORACLES, QUERIES  # noqa: F401
