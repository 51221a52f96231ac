"""Queries: imputation, encoding, transform spec fit/apply.

The spec is fitted on the training split of the feature table and applied to
the clean test split and to its schema_change corruption (unseen categories).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from cohortwatch import schemas as S
from cohortwatch.functions.codes import DIAGNOSIS_GROUPS, ordinal_encode
from cohortwatch.functions.values import split_prefixed_name
from cohortwatch.operators import clean as C
from cohortwatch.operators import corrupt as X
from cohortwatch.operators import encode as EN
from cohortwatch.plans.fixtures import ENCOUNTERS_SQL, encounters
from cohortwatch.plans.q_scenario import COLS, KEY, SEED, SPLIT_CTES, _split
from cohortwatch.plans.registry import register, with_ctes

NUM = S.NUMERIC_FEATURES
CAT = S.CATEGORICAL_FEATURES
ONEHOT = ["diag_1_category", "medical_specialty_grouped"]
# Fixed list for the fixed-category one-hot: every label the code grouping can give.
DIAG_CATEGORIES = [g[0] for g in DIAGNOSIS_GROUPS] + ["Other", "Missing"]


def r6(c):
    return F.round(c, 6)


def _frames(spark, sf_dir):
    sp = _split(spark, sf_dir)
    train = sp.filter(F.col("split") == "train").drop("split")
    test = sp.filter(F.col("split") == "test").drop("split")
    return train, test


def _spec(train):
    return EN.fit_spec(train, S.FEATURE_COLUMNS, NUM, CAT, "gender", ONEHOT)


def _current(test):
    """clean test rows plus their schema_change corruption, tagged by scenario."""
    return test.withColumn("scenario", F.lit("clean")).unionByName(
        X.schema_change(test, KEY, SEED).withColumn("scenario", F.lit("schema_change")))


def _mode_sql(c):
    return (f"(SELECT v FROM (SELECT CAST({c} AS VARCHAR) AS v, count(*) AS k FROM train0 WHERE {c} IS NOT NULL "
            f"GROUP BY 1) ORDER BY k DESC, v LIMIT 1)")


def _vocab_sql(c):
    return (f"SELECT v, row_number() OVER (ORDER BY n DESC, v) AS si FROM (SELECT COALESCE(CAST({c} AS VARCHAR), "
            f"{_mode_sql(c)}) AS v, count(*) AS n FROM train0 GROUP BY 1)")


ENC_CTES = dict(
    SPLIT_CTES,
    cur=f"SELECT {', '.join(COLS)}, 'clean' AS scenario FROM test UNION ALL "
        f"SELECT {', '.join(COLS)}, 'schema_change' FROM corrupted WHERE scenario = 'schema_change'",
    omap="SELECT v, CAST(row_number() OVER (ORDER BY v) - 1 AS BIGINT) AS code FROM (SELECT DISTINCT "
         f"COALESCE(CAST(gender AS VARCHAR), {_mode_sql('gender')}) AS v FROM train0)",
    **{f"voc_{c}": _vocab_sql(c) for c in ONEHOT},
)


@register("mode_mean_fit", with_ctes(" UNION ALL ".join(
    [f"SELECT '{c}' AS column_name, 'numeric' AS kind, round(avg({c}), 6) AS fill_num, "
     f"CAST(NULL AS VARCHAR) AS fill_text FROM train0" for c in NUM]
    + [f"SELECT '{c}', 'categorical', CAST(NULL AS DOUBLE), {_mode_sql(c)}" for c in CAT]), **ENC_CTES))
def q_mode_mean_fit(spark, sf_dir):
    """Mean per numeric column, most frequent value per categorical column."""
    spec = _spec(_frames(spark, sf_dir)[0])
    rows = [(c, "numeric", spec.numeric_fill[c], None) for c in NUM]
    rows += [(c, "categorical", None, spec.categorical_fill[c]) for c in CAT]
    df = spark.createDataFrame(rows, "column_name string, kind string, fill_num double, fill_text string")
    return df.select("column_name", "kind", r6("fill_num").alias("fill_num"), "fill_text")


def _spec_items_sql():
    parts = []
    for i, c in enumerate(S.FEATURE_COLUMNS):
        if c in ONEHOT:
            parts.append(f"SELECT {i} AS fi, si, '{c}_' || v AS output_column, '{c}' AS source_column, "
                         f"'onehot' AS role, v AS category FROM voc_{c}")
        else:
            role = "ordinal" if c == "gender" else "numeric"
            parts.append(f"SELECT {i} AS fi, 0 AS si, '{c}' AS output_column, '{c}' AS source_column, "
                         f"'{role}' AS role, CAST(NULL AS VARCHAR) AS category")
    return " UNION ALL ".join(parts)


@register("transform_spec_fit", with_ctes(
    "SELECT output_column, CAST(row_number() OVER (ORDER BY fi, si) - 1 AS INT) AS position, source_column, role, "
    "category FROM items", **ENC_CTES, items=_spec_items_sql()))
def q_transform_spec_fit(spark, sf_dir):
    """The fitted spec as rows (output order, source column, role, category)."""
    spec = _spec(_frames(spark, sf_dir)[0])
    return EN.spec_table(spark, spec).select("output_column", "position", "source_column", "role", "category")


def _impute_sql(c):
    if c in NUM:
        return f"round(COALESCE(CAST({c} AS DOUBLE), (SELECT avg({c}) FROM train0)), 6) AS {c}"
    return f"COALESCE(CAST({c} AS VARCHAR), {_mode_sql(c)}) AS {c}"


@register("impute_apply", with_ctes(
    f"SELECT {KEY}, {', '.join(_impute_sql(c) for c in S.FEATURE_COLUMNS)} FROM test", **ENC_CTES))
def q_impute_apply(spark, sf_dir):
    """Fitted means and modes filled into the test split."""
    train, test = _frames(spark, sf_dir)
    spec = _spec(train)
    out = EN.impute(test, spec.numeric_fill, spec.categorical_fill)
    return out.select(KEY, *[r6(c).alias(c) if c in NUM else F.col(c) for c in S.FEATURE_COLUMNS])


@register("ordinal_encode", with_ctes(
    f"SELECT {KEY}, scenario, gender, COALESCE((SELECT code FROM omap WHERE omap.v = cur.gender), -1) AS gender_code "
    f"FROM cur", **ENC_CTES))
def q_ordinal_encode(spark, sf_dir):
    """fitted codes, unseen and null -> -1."""
    train, test = _frames(spark, sf_dir)
    spec = _spec(train)
    cur = _current(test)
    return cur.select(KEY, "scenario", "gender", ordinal_encode("gender", spec.ordinal_map).alias("gender_code"))


@register("onehot_fixed", with_ctes(
    f"SELECT {KEY}, scenario, " + ", ".join(
        f"CASE WHEN diag_1_category IS NOT DISTINCT FROM '{c}' THEN 1 ELSE 0 END AS diag_1_category_{c}"
        for c in DIAG_CATEGORIES) + " FROM cur", **ENC_CTES))
def q_onehot_fixed(spark, sf_dir):
    """one 0/1 column per fixed category; unseen values give all zeros."""
    from cohortwatch.functions.codes import one_hot
    _, test = _frames(spark, sf_dir)
    return _current(test).select(KEY, "scenario", *one_hot("diag_1_category", "diag_1_category", DIAG_CATEGORIES))


@register("onehot_discovered", with_ctes(
    f"SELECT t.{KEY}, 'medical_specialty_grouped_' || d.v AS dummy_column, "
    f"CASE WHEN CAST(t.medical_specialty_grouped AS VARCHAR) = d.v THEN 1 ELSE 0 END AS indicator "
    f"FROM test t, (SELECT DISTINCT CAST(medical_specialty_grouped AS VARCHAR) AS v FROM test "
    f"WHERE medical_specialty_grouped IS NOT NULL) d", **ENC_CTES))
def q_onehot_discovered(spark, sf_dir):
    """categories discovered from the frame itself, then the fixed one-hot (long form)."""
    _, test = _frames(spark, sf_dir)
    vocab = EN.vocabularies(test, ["medical_specialty_grouped"])["medical_specialty_grouped"]
    return EN.dummies_long(test, KEY, "medical_specialty_grouped", vocab)


@register("align_columns", with_ctes(
    f"SELECT c.{KEY}, c.scenario, 'medical_specialty_grouped_' || d.v AS dummy_column, "
    f"CASE WHEN CAST(c.medical_specialty_grouped AS VARCHAR) = d.v THEN 1 ELSE 0 END AS indicator "
    f"FROM cur c, (SELECT DISTINCT CAST(medical_specialty_grouped AS VARCHAR) AS v FROM train0 "
    f"WHERE medical_specialty_grouped IS NOT NULL) d", **ENC_CTES))
def q_align_columns(spark, sf_dir):
    """train categories decide the dummy columns of the current rows; unseen -> all zero."""
    train, test = _frames(spark, sf_dir)
    vocab = EN.vocabularies(train, ["medical_specialty_grouped"])["medical_specialty_grouped"]
    cur = _current(test)
    long = cur.select(KEY, "scenario", F.inline(F.array(*[
        F.struct(F.lit(f"medical_specialty_grouped_{v}").alias("dummy_column"),
                 F.col("medical_specialty_grouped").eqNullSafe(F.lit(v)).cast("long").alias("indicator"))
        for v in vocab])))
    return long


def _apply_sql():
    parts = []
    for c in S.FEATURE_COLUMNS:
        if c in ONEHOT:
            parts.append(f"SELECT c.{KEY}, c.scenario, '{c}_' || voc.v AS feature, "
                         f"CASE WHEN COALESCE(CAST(c.{c} AS VARCHAR), {_mode_sql(c)}) = voc.v THEN 1.0 ELSE 0.0 END "
                         f"AS value FROM cur c, voc_{c} voc")
        elif c == "gender":
            parts.append(f"SELECT {KEY}, scenario, 'gender' AS feature, CAST(COALESCE((SELECT code FROM omap WHERE "
                         f"omap.v = COALESCE(CAST(cur.gender AS VARCHAR), {_mode_sql('gender')})), -1) AS DOUBLE) "
                         f"AS value FROM cur")
        else:
            parts.append(f"SELECT {KEY}, scenario, '{c}' AS feature, round(COALESCE(CAST({c} AS DOUBLE), "
                         f"(SELECT avg({c}) FROM train0)), 6) AS value FROM cur")
    return " UNION ALL ".join(parts)


_SPLIT_NAME_SQL = " ".join(f"WHEN starts_with(feature, '{c}_') THEN '{c}'" for c in ONEHOT)
_SPLIT_CAT_SQL = " ".join(f"WHEN starts_with(feature, '{c}_') THEN substr(feature, {len(c) + 2})" for c in ONEHOT)


@register("transform_apply", with_ctes(
    f"SELECT *, CASE {_SPLIT_NAME_SQL} ELSE feature END AS source_column, "
    f"CASE {_SPLIT_CAT_SQL} END AS category FROM applied", **ENC_CTES, applied=_apply_sql()))
def q_transform_apply(spark, sf_dir):
    """Impute -> ordinal -> one-hot -> fitted column order, shown in long form."""
    train, test = _frames(spark, sf_dir)
    spec = _spec(train)
    wide = EN.apply_spec(_current(test), spec, keep=[KEY, "scenario"])
    typed = wide.select(KEY, "scenario", *[F.col(f"`{c}`").cast("double").alias(c) for c in spec.output_columns])
    long = typed.unpivot([KEY, "scenario"], [F.col(f"`{c}`") for c in spec.output_columns], "feature", "value")
    source, category = split_prefixed_name("feature", ONEHOT)
    return long.select(KEY, "scenario", "feature", r6("value").alias("value"), source.alias("source_column"),
                       category.alias("category"))


@register("sparse_encode", with_ctes(
    f"SELECT a.{KEY}, a.scenario, CAST(i.position AS INT) AS position, a.value FROM applied a JOIN "
    "(SELECT output_column, row_number() OVER (ORDER BY fi, si) - 1 AS position FROM items) i ON a.feature = i.output_column "
    "WHERE a.value <> 0", **ENC_CTES, applied=_apply_sql(), items=_spec_items_sql()))
def q_sparse_encode(spark, sf_dir):
    """The encoded records as sparse rows in the training column order, shown entry by entry."""
    train, test = _frames(spark, sf_dir)
    rows = EN.sparse_rows(_current(test), _spec(train), keep=[KEY, "scenario"])
    entries = rows.select(KEY, "scenario", F.inline(F.arrays_zip("positions", "values")))
    return entries.select(KEY, "scenario", F.col("positions").alias("position"), r6("values").alias("value"))


@register("transform_lacking", with_ctes(
    f"SELECT {KEY}, (SELECT round(avg(num_medications), 6) FROM train0) AS num_medications, "
    f"round(COALESCE(CAST(time_in_hospital AS DOUBLE), (SELECT avg(time_in_hospital) FROM train0)), 6) AS time_in_hospital FROM test", **ENC_CTES))
def q_transform_lacking(spark, sf_dir):
    """A frame without one of the fitted columns gets it imputed."""
    train, test = _frames(spark, sf_dir)
    out = EN.apply_spec(test.drop("num_medications"), _spec(train), keep=[KEY])
    return out.select(KEY, r6(F.col("num_medications").cast("double")).alias("num_medications"), r6(F.col("time_in_hospital").cast("double")).alias("time_in_hospital"))


@register("conform_columns", with_ctes(
    f"SELECT {KEY}, num_medications, time_in_hospital, 0 AS weight_kg, gender FROM test", **ENC_CTES))
def q_conform_columns(spark, sf_dir):
    """Expected columns in order; absent ones as 0; extras dropped."""
    _, test = _frames(spark, sf_dir)
    return C.conform_columns(test, [KEY, "num_medications", "time_in_hospital", "weight_kg", "gender"])


# diag_1 with spellings mixed in that look like numbers to one parser or another
AWKWARD_SQL = ("CASE encounter_id % 7 WHEN 0 THEN '12d' WHEN 1 THEN '1_000' WHEN 2 THEN ' 7 ' WHEN 3 THEN '1e3' "
               "WHEN 4 THEN '0x1F' ELSE diag_1 END")


@register("coerce_numeric", with_ctes(
    f"SELECT encounter_id, diag_1, CASE WHEN regexp_full_match({AWKWARD_SQL}, '\\s*[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)([eE][+-]?[0-9]+)?\\s*') "
    f"THEN TRY_CAST(trim({AWKWARD_SQL}) AS DOUBLE) END AS diag_num FROM enc", enc=ENCOUNTERS_SQL))
def q_coerce_numeric(spark, sf_dir):
    """P10: text to number; bad values (a suffix, digit groups, words) -> null."""
    enc = encounters(spark, sf_dir).withColumn("diag_num", F.expr(AWKWARD_SQL))
    return C.coerce_numeric(enc, ["diag_num"]).select("encounter_id", "diag_1", "diag_num")


@register("unseen_categories", with_ctes(
    "SELECT column_name, value, count(*) AS n FROM ("
    + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, CAST({c} AS VARCHAR) AS value FROM cur WHERE scenario = 'schema_change' "
        f"AND {c} IS NOT NULL AND CAST({c} AS VARCHAR) NOT IN (SELECT v FROM {'omap' if c == 'gender' else 'voc_' + c})"
        for c in ["gender"] + ONEHOT) + ") GROUP BY ALL", **ENC_CTES))
def q_unseen_categories(spark, sf_dir):
    """P20: values of the corrupted rows outside the fitted vocabularies."""
    train, test = _frames(spark, sf_dir)
    spec = _spec(train)
    cur = X.schema_change(test, KEY, SEED)
    out = EN.unseen_values(cur, spec, ["gender"] + ONEHOT)
    return out.select(F.col("column").alias("column_name"), "value", "n")
