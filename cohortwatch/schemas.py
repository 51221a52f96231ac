"""Schemas and column roles of the clinical configuration.

Operators take column names as arguments; this module is one configuration
(the clinical encounter cohort), the test fixtures are another.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values (must equal the reference for right results).
PLACEHOLDER = "?"
DROP_COLUMNS = ["weight", "payer_code"]
FILL_MISSING = {"race": "Missing", "medical_specialty": "Missing"}
MISSING_MARKER = -1
RECODE_TO_MISSING = {
    "admission_type_id": [5, 6, 8],
    "discharge_disposition_id": [18, 25],
    "admission_source_id": [9, 17, 20],
}
HOSPICE_EXPIRED_CODES = [11, 13, 14, 19, 20]
INVALID_GENDER = "Unknown/Invalid"
TARGET_NEGATIVE = "NO"
WHITE_RACE = "Caucasian"
SPECIALTY_MIN_SHARE_PCT = 1.0
FEATURE_TTL_DAYS = 3650
DRIFT_REFERENCE_ROWS = 5000
ROLLING_WINDOW_ROWS = 3000
ROLLING_MIN_NEW_ROWS = 600
ROLLING_MIN_WINDOW_ROWS = 2000
DATASET_DRIFT_SHARE = 0.5
PREDICTION_THRESHOLD = 0.5
PRED_SHIFT_ALERT_DELTA = 0.10
BASELINE_POSITIVE_RATIO = 0.244
PARITY_TOLERANCE = 0.02
REPLAY_TOLERANCE = 1e-9
SPLIT_TEST_SIZE = 0.2
SPLIT_SEED = 42
N_FOLDS = 10
TUNING_DRAWS = 25

CATEGORICAL_FEATURES = ["diag_1_category", "medical_specialty_grouped", "gender"]
FEATURE_COLUMNS = [
    "time_in_hospital", "num_lab_procedures", "num_procedures", "num_medications",
    "number_outpatient", "number_emergency", "number_inpatient", "number_diagnoses",
    "admission_type_id", "discharge_disposition_id", "admission_source_id",
    "diag_1_category", "medical_specialty_grouped", "race_white", "gender", "age_ordinal",
]
NUMERIC_FEATURES = [c for c in FEATURE_COLUMNS if c not in CATEGORICAL_FEATURES]
TARGET = "readmitted_binary"
ENTITY_KEY = "encounter_id"
PATIENT_KEY = "patient_nbr"
# ---------------------------------------------------------------------------

FEATURE_SCHEMA = T.StructType(
    [T.StructField(c, T.StringType() if c in CATEGORICAL_FEATURES else T.LongType(), True)
     for c in FEATURE_COLUMNS]
)

DRIFT_VERDICT_SCHEMA = T.StructType([
    T.StructField("dataset_drift", T.BooleanType()),
    T.StructField("n_drifted", T.LongType()),
    T.StructField("drift_share", T.DoubleType()),
    T.StructField("n_columns", T.LongType()),
])

METRIC_SAMPLE_SCHEMA = T.StructType([
    T.StructField("ts", T.TimestampType()),
    T.StructField("name", T.StringType()),
    T.StructField("labels", T.MapType(T.StringType(), T.StringType())),
    T.StructField("value", T.DoubleType()),
])
