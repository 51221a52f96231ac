"""Named corruptions of a table for stress tests.

Each corruption is ``fn(df, key, seed) -> df`` with the schema kept. Random
draws are hashes of (row key, seed, scenario, column), so a row is corrupted
the same way under any partitioning or retry.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortwatch.functions.values import clip, hash_choice, hash_int, hash_uniform
from cohortwatch.operators.clean import swap_columns

# ---------------------------------------------------------------------------
# Fixed values (stress-test scenarios).
OOB_LAB_SCALE, OOB_LAB_SHIFT = 50, 5000
OOB_STAY = 9999
OOB_MEDS_RANGE = (500, 1000)
OOB_DIAGNOSES_SHIFT = 900
SWAP_PAIRS = [("num_medications", "num_lab_procedures"), ("num_procedures", "time_in_hospital")]
UNKNOWN_GENDER, UNKNOWN_GENDER_SHARE = "UNKNOWN", 0.4
UNSEEN_DIAGNOSES = ["ZZZ", "NEW_CODE", "Unmapped"]
UNSEEN_SPECIALTY = "BrandNewSpecialty"
SHIFT_AGE, AGE_BOUNDS = (2, 5), (0, 9)
SHIFT_STAY, STAY_BOUNDS = (4, 10), (1, 14)
SHIFT_INPATIENT = (2, 6)
SHIFT_EMERGENCY = (1, 4)
# ---------------------------------------------------------------------------


def _typed(df: DataFrame, col: str, expr):
    return expr.cast(df.schema[col].dataType)


def out_of_bounds(df: DataFrame, key: str, seed: int) -> DataFrame:
    return df.withColumns({
        "num_lab_procedures": _typed(df, "num_lab_procedures", F.col("num_lab_procedures") * OOB_LAB_SCALE + OOB_LAB_SHIFT),
        "time_in_hospital": _typed(df, "time_in_hospital", F.lit(OOB_STAY)),
        "num_medications": _typed(df, "num_medications", hash_int(key, seed, *OOB_MEDS_RANGE, "out_of_bounds:meds")),
        "number_diagnoses": _typed(df, "number_diagnoses", F.col("number_diagnoses") + OOB_DIAGNOSES_SHIFT),
    })


def column_swap(df: DataFrame, key: str, seed: int) -> DataFrame:
    return swap_columns(df, SWAP_PAIRS)


def schema_change(df: DataFrame, key: str, seed: int) -> DataFrame:
    unknown = hash_uniform(key, seed, "schema_change:gender") < UNKNOWN_GENDER_SHARE
    return df.withColumns({
        "gender": F.when(unknown, F.lit(UNKNOWN_GENDER)).otherwise(F.col("gender")),
        "diag_1_category": hash_choice(key, seed, UNSEEN_DIAGNOSES, "schema_change:diag"),
        "medical_specialty_grouped": F.lit(UNSEEN_SPECIALTY),
    })


def dist_shift(df: DataFrame, key: str, seed: int) -> DataFrame:
    return df.withColumns({
        "age_ordinal": _typed(df, "age_ordinal", clip(F.col("age_ordinal") + hash_int(
            key, seed, *SHIFT_AGE, "dist_shift:age"), *AGE_BOUNDS)),
        "time_in_hospital": _typed(df, "time_in_hospital", clip(F.col("time_in_hospital") + hash_int(
            key, seed, *SHIFT_STAY, "dist_shift:stay"), *STAY_BOUNDS)),
        "number_inpatient": _typed(df, "number_inpatient", F.col("number_inpatient") + hash_int(
            key, seed, *SHIFT_INPATIENT, "dist_shift:inpatient")),
        "number_emergency": _typed(df, "number_emergency", F.col("number_emergency") + hash_int(
            key, seed, *SHIFT_EMERGENCY, "dist_shift:emergency")),
    })


SCENARIOS: Mapping[str, Callable[[DataFrame, str, int], DataFrame]] = {
    "out_of_bounds": out_of_bounds,
    "column_swap": column_swap,
    "schema_change": schema_change,
    "dist_shift": dist_shift,
}


def corrupt_all(df: DataFrame, key: str, seed: int, scenarios: Mapping = SCENARIOS,
                column: str = "scenario") -> DataFrame:
    """Every scenario applied to the base table, tagged by name, as one DataFrame."""
    out = None
    for name, fn in scenarios.items():
        part = fn(df, key, seed).withColumn(column, F.lit(name))
        out = part if out is None else out.unionByName(part)
    return out
