"""Queries: cleaning, keys, code groups, feature pipeline (P, W01, W05, U02, W06, F01-F05, M01, M02)."""

from __future__ import annotations

from pyspark.sql import functions as F

from cohortwatch import schemas as S
from cohortwatch.functions.codes import (flag_equal, flag_not_equal,
                                         ordinal_lookup)
from cohortwatch.functions.values import clip
from cohortwatch.operators import clean as C
from cohortwatch.operators import features as FE
from cohortwatch.operators import profile as PR
from cohortwatch.operators.windows import rolling_rows
from cohortwatch.plans.fixtures import (ENCOUNTERS_SQL, LINE_CODES_SQL, encounters,
                                        line_codes, read_table)
from cohortwatch.plans.registry import register, with_ctes

STRING_COLS = ["race", "gender", "age", "weight", "payer_code", "medical_specialty", "diag_1", "readmitted"]
OTHER_COLS = ["encounter_id", "patient_nbr", "admission_type_id", "discharge_disposition_id",
              "admission_source_id", "time_in_hospital", "num_lab_procedures", "num_procedures",
              "num_medications", "number_outpatient", "number_emergency", "number_inpatient",
              "number_diagnoses", "admit_ts"]
LOAD_TS = "2024-06-01 00:00:00"

_nullif = ", ".join(f"NULLIF({c}, '?') AS {c}" for c in STRING_COLS)
P01_SQL = f"SELECT {', '.join(OTHER_COLS)}, {_nullif} FROM enc"


def _in_list(vals):
    return ", ".join(str(v) for v in vals)


_recode = ", ".join(
    f"CAST(CASE WHEN {c} IN ({_in_list(v)}) THEN -1 ELSE {c} END AS INT) AS {c}"
    for c, v in S.RECODE_TO_MISSING.items())
_keep_other = [c for c in OTHER_COLS if c not in S.RECODE_TO_MISSING]
_keep_str = [c for c in STRING_COLS if c not in S.DROP_COLUMNS + list(S.FILL_MISSING)]
CLEAN_SQL = f"""
SELECT {', '.join(_keep_other)}, {', '.join(_keep_str)},
  COALESCE(race, 'Missing') AS race, COALESCE(medical_specialty, 'Missing') AS medical_specialty,
  {_recode}
FROM p01
"""
CLEAN_FILTERED_SQL = f"""
SELECT * FROM c1
WHERE NOT COALESCE(discharge_disposition_id IN ({_in_list(S.HOSPICE_EXPIRED_CODES)}), false)
  AND gender IS DISTINCT FROM 'Unknown/Invalid'
QUALIFY row_number() OVER (PARTITION BY patient_nbr ORDER BY encounter_id) = 1
"""


def clean_encounters(spark, sf_dir):
    return C.clean_pipeline(
        encounters(spark, sf_dir), placeholder=S.PLACEHOLDER, drop=S.DROP_COLUMNS,
        fills=S.FILL_MISSING, recodes=S.RECODE_TO_MISSING, marker=S.MISSING_MARKER,
        exclude_column="discharge_disposition_id", exclude_codes=S.HOSPICE_EXPIRED_CODES,
        invalid_column="gender", invalid_value=S.INVALID_GENDER,
        key=S.PATIENT_KEY, order=S.ENTITY_KEY)


CLEAN_CTES = dict(enc=ENCOUNTERS_SQL, p01=P01_SQL, c1=CLEAN_SQL, clean=CLEAN_FILTERED_SQL)


@register("placeholder_null", with_ctes("SELECT * FROM p01", enc=ENCOUNTERS_SQL, p01=P01_SQL))
def q_placeholder_null(spark, sf_dir):
    return C.placeholder_to_null(encounters(spark, sf_dir), S.PLACEHOLDER)


@register("fill_missing", with_ctes(
    "SELECT encounter_id, COALESCE(race, 'Missing') AS race, "
    "COALESCE(medical_specialty, 'Missing') AS medical_specialty FROM p01",
    enc=ENCOUNTERS_SQL, p01=P01_SQL))
def q_fill_missing(spark, sf_dir):
    df = C.placeholder_to_null(encounters(spark, sf_dir), S.PLACEHOLDER)
    return C.fill_missing(df, S.FILL_MISSING).select("encounter_id", "race", "medical_specialty")


@register("recode_codes", with_ctes(
    f"SELECT encounter_id, {_recode} FROM enc", enc=ENCOUNTERS_SQL))
def q_recode_codes(spark, sf_dir):
    df = C.recode_codes(encounters(spark, sf_dir), S.RECODE_TO_MISSING, S.MISSING_MARKER)
    return df.select("encounter_id", *S.RECODE_TO_MISSING)


@register("antifilter_keep_null", with_ctes(
    f"SELECT encounter_id, discharge_disposition_id FROM enc "
    f"WHERE NOT COALESCE(discharge_disposition_id IN ({_in_list(S.HOSPICE_EXPIRED_CODES)}), false)",
    enc=ENCOUNTERS_SQL))
def q_antifilter(spark, sf_dir):
    df = C.anti_filter_keep_null(encounters(spark, sf_dir), "discharge_disposition_id", S.HOSPICE_EXPIRED_CODES)
    return df.select("encounter_id", "discharge_disposition_id")


@register("notequal_keep_null", with_ctes(
    "SELECT encounter_id, gender FROM p01 WHERE gender IS DISTINCT FROM 'Unknown/Invalid'",
    enc=ENCOUNTERS_SQL, p01=P01_SQL))
def q_notequal(spark, sf_dir):
    df = C.placeholder_to_null(encounters(spark, sf_dir), S.PLACEHOLDER)
    return C.not_equal_filter_keep_null(df, "gender", S.INVALID_GENDER).select("encounter_id", "gender")


@register("clean_pipeline", with_ctes(
    f"SELECT *, TIMESTAMP '{LOAD_TS}' AS loaded_at FROM clean", **CLEAN_CTES))
def q_clean_pipeline(spark, sf_dir):
    return C.stamp(clean_encounters(spark, sf_dir), "loaded_at", LOAD_TS)


# ---- keys -----------------------------------------------------------------

@register("first_per_key", """
SELECT o_custkey, o_orderkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) = 1
""")
def q_first_per_key(spark, sf_dir):
    return C.first_per_key(read_table(spark, sf_dir, "orders"), "o_custkey", ["o_orderdate", "o_orderkey"])


@register("latest_per_key", """
SELECT user_id, event_id, ts, event_type, value FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1
""")
def q_latest_per_key(spark, sf_dir):
    ev = read_table(spark, sf_dir, "events").select("user_id", "event_id", "ts", "event_type", "value")
    return C.first_per_key(ev, "user_id", ["ts", "event_id"], descending=True)


@register("distinct_by_key", """
SELECT DISTINCT o_custkey, o_orderstatus FROM orders
""")
def q_distinct_by_key(spark, sf_dir):
    return read_table(spark, sf_dir, "orders").select("o_custkey", "o_orderstatus").dropDuplicates()


@register("rolling_rows", """
SELECT event_id,
  CAST(count(*) OVER w AS BIGINT) AS n_window,
  CAST(sum(CAST(value AS DECIMAL(18, 2))) OVER w AS DOUBLE) AS sum_window,
  CAST(sum(CAST(value AS DECIMAL(18, 2))) OVER w AS DOUBLE) / count(*) OVER w AS mean_window
FROM events
WINDOW w AS (ORDER BY event_id ROWS BETWEEN 2999 PRECEDING AND CURRENT ROW)
""")
def q_rolling_rows(spark, sf_dir):
    ev = read_table(spark, sf_dir, "events")
    out = rolling_rows(ev, "event_id", "value", S.ROLLING_WINDOW_ROWS, decimal_scale=2)
    return out.select("event_id", "n_window", "sum_window",
                      (F.col("sum_window") / F.col("n_window")).alias("mean_window"))


# ---- code groups and features ---------------------------------------------

def code_group_sql(code: str, x: str) -> str:
    """Oracle text of the code grouping: ``code`` the text column, ``x`` its numeric value."""
    return f"""
CASE WHEN {code} IS NULL THEN 'Missing'
     WHEN starts_with({code}, 'V') OR starts_with({code}, 'E') THEN 'Other'
     WHEN NOT regexp_matches({code}, '^\\s*[+-]?[0-9]+(\\.[0-9]*)?\\s*$') THEN 'Other'
     WHEN ({x} >= 390 AND {x} <= 459) OR {x} = 785 THEN 'Circulatory'
     WHEN ({x} >= 460 AND {x} <= 519) OR {x} = 786 THEN 'Respiratory'
     WHEN ({x} >= 520 AND {x} <= 579) OR {x} = 787 THEN 'Digestive'
     WHEN {x} >= 250 AND {x} < 251 THEN 'Diabetes'
     WHEN {x} >= 800 AND {x} <= 999 THEN 'Injury'
     WHEN {x} >= 710 AND {x} <= 739 THEN 'Musculoskeletal'
     WHEN ({x} >= 580 AND {x} <= 629) OR {x} = 788 THEN 'Genitourinary'
     WHEN {x} >= 140 AND {x} <= 239 THEN 'Neoplasms'
     ELSE 'Other' END
"""


@register("code_groups", with_ctes(
    f"SELECT l_orderkey, l_linenumber, code, {code_group_sql('code', 'x')} AS code_group FROM lc",
    lc0=LINE_CODES_SQL,
    lc="SELECT *, TRY_CAST(trim(code) AS DOUBLE) AS x FROM lc0"))
def q_code_groups(spark, sf_dir):
    return FE.add_code_groups(line_codes(spark, sf_dir), "code", "code_group")


@register("flag_neq", with_ctes(
    "SELECT encounter_id, CASE WHEN readmitted IS DISTINCT FROM 'NO' THEN 1 ELSE 0 END AS readmitted_binary FROM p01",
    enc=ENCOUNTERS_SQL, p01=P01_SQL))
def q_flag_neq(spark, sf_dir):
    df = C.placeholder_to_null(encounters(spark, sf_dir), S.PLACEHOLDER)
    return df.select("encounter_id", flag_not_equal("readmitted", S.TARGET_NEGATIVE).alias("readmitted_binary"))


@register("flag_eq", with_ctes(
    "SELECT encounter_id, CASE WHEN race IS NOT DISTINCT FROM 'Caucasian' THEN 1 ELSE 0 END AS race_white FROM p01",
    enc=ENCOUNTERS_SQL, p01=P01_SQL))
def q_flag_eq(spark, sf_dir):
    df = C.placeholder_to_null(encounters(spark, sf_dir), S.PLACEHOLDER)
    return df.select("encounter_id", flag_equal("race", S.WHITE_RACE).alias("race_white"))


_AGE_CASE = "CASE age " + " ".join(
    f"WHEN '[{10 * i}-{10 * i + 10})' THEN {i}" for i in range(10)) + " END"


@register("ordinal_band", with_ctes(
    f"SELECT encounter_id, age, {_AGE_CASE} AS age_ordinal FROM enc", enc=ENCOUNTERS_SQL))
def q_ordinal_band(spark, sf_dir):
    return encounters(spark, sf_dir).select("encounter_id", "age", ordinal_lookup("age").alias("age_ordinal"))


RARE_SQL = """
SELECT p_partkey, p_brand,
  CASE WHEN p_brand IN (SELECT p_brand FROM shares WHERE pct >= 4.0) THEN p_brand ELSE 'Other' END AS brand_grouped
FROM part
"""
SHARES_SQL = "SELECT p_brand, count(*) * 100.0 / (SELECT count(p_brand) FROM part) AS pct FROM part WHERE p_brand IS NOT NULL GROUP BY p_brand"


@register("rare_bucket", with_ctes(RARE_SQL, shares=SHARES_SQL))
def q_rare_bucket(spark, sf_dir):
    part = read_table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    return FE.rare_bucket(part, "p_brand", "brand_grouped", 4.0)


@register("clip_values", """
SELECT l_orderkey, l_linenumber,
  LEAST(GREATEST(l_quantity, 5.0), 40.0) AS qty_clipped,
  l_quantity * 50 + 5000 AS qty_shifted,
  LEAST(l_linenumber, 5) AS line_capped
FROM lineitem
""")
def q_clip_values(spark, sf_dir):
    li = read_table(spark, sf_dir, "lineitem")
    return li.select("l_orderkey", "l_linenumber",
                     clip("l_quantity", 5.0, 40.0).alias("qty_clipped"),
                     (F.col("l_quantity") * 50 + 5000).alias("qty_shifted"),
                     clip("l_linenumber", high=5).alias("line_capped"))


FEATURES_SQL = f"""
SELECT clean.*,
  CASE WHEN readmitted IS DISTINCT FROM 'NO' THEN 1 ELSE 0 END AS readmitted_binary,
  {code_group_sql('diag_1', 'dx')} AS diag_1_category,
  CASE WHEN medical_specialty IN (SELECT medical_specialty FROM spec WHERE pct >= 1.0)
       THEN medical_specialty ELSE 'Other' END AS medical_specialty_grouped,
  CASE WHEN race IS NOT DISTINCT FROM 'Caucasian' THEN 1 ELSE 0 END AS race_white,
  {_AGE_CASE} AS age_ordinal
FROM (SELECT *, TRY_CAST(trim(diag_1) AS DOUBLE) AS dx FROM clean) clean
"""
SPEC_SQL = ("SELECT medical_specialty, count(*) * 100.0 / (SELECT count(medical_specialty) FROM clean) AS pct "
            "FROM clean WHERE medical_specialty IS NOT NULL GROUP BY medical_specialty")
FEATURE_CTES = dict(CLEAN_CTES, spec=SPEC_SQL, feat=FEATURES_SQL)


def feature_table(spark, sf_dir, clean=None):
    """The feature table, from ``clean`` where that is stored already."""
    return FE.feature_pipeline(
        clean_encounters(spark, sf_dir) if clean is None else clean, target_source="readmitted", target_negative=S.TARGET_NEGATIVE,
        target=S.TARGET, code_column="diag_1", code_out="diag_1_category",
        rare_column="medical_specialty", rare_out="medical_specialty_grouped",
        min_share_pct=S.SPECIALTY_MIN_SHARE_PCT, flag_column="race", flag_value=S.WHITE_RACE,
        flag_out="race_white", band_column="age", band_out="age_ordinal")


@register("feature_pipeline", with_ctes("SELECT * EXCLUDE (dx) FROM feat", **FEATURE_CTES))
def q_feature_pipeline(spark, sf_dir):
    return feature_table(spark, sf_dir)


@register("first_encounter_rate", with_ctes("""
SELECT age_ordinal, count(*) AS n, round(avg(CAST(readmitted_binary AS DOUBLE)), 6) AS rate,
  round(count(*) * 100.0 / sum(count(*)) OVER (), 2) AS pct_rows
FROM feat GROUP BY age_ordinal
""", **FEATURE_CTES))
def q_first_encounter_rate(spark, sf_dir):
    """Flagship: target rate by age band over first encounters (clean -> features -> G07)."""
    feats = feature_table(spark, sf_dir)
    rates = PR.rate_by_group(feats, "age_ordinal", S.TARGET)
    total = feats.agg(F.count(F.lit(1))).scalar()
    return (rates.select("age_ordinal", "n", F.round("rate", 6).alias("rate"),
                         F.round(F.col("n") * 100.0 / total, 2).alias("pct_rows"))
                 .orderBy(F.asc_nulls_last("age_ordinal")))
