"""Imputation and encoding.

``fit_spec`` learns a small transform spec (means, modes, ordinal map, one-hot
vocabularies) with three aggregations; the spec is a few hundred values at
most, held on the driver like model parameters and also available as a table.
``apply_spec`` is a single ``select`` of native expressions, so scoring a batch
is one narrow stage.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortwatch.functions.codes import ordinal_encode
from cohortwatch.functions.values import to_number
from cohortwatch.operators.clean import add_absent_columns
from cohortwatch.operators.profile import mode_per_column

UNKNOWN_ORDINAL = -1
# One-hot columns that a fitted spec may have; more is an error, not a cut.
MAX_VOCABULARY = 10_000


@dataclass
class TransformSpec:
    numeric_columns: list[str]
    numeric_fill: dict[str, float]
    categorical_columns: list[str]
    categorical_fill: dict[str, str]
    ordinal_column: str | None
    ordinal_map: dict[str, int]
    onehot: dict[str, list[str]]
    output_columns: list[str] = field(default_factory=list)

    def to_json(self) -> str:
        return json.dumps(asdict(self), sort_keys=True)

    @classmethod
    def from_json(cls, text: str) -> "TransformSpec":
        return cls(**json.loads(text))


def impute(df: DataFrame, numeric_fill: dict, categorical_fill: dict) -> DataFrame:
    """Numeric -> coerce then fill with the mean; categorical -> fill with the mode."""
    cols = {c: F.coalesce(to_number(c), F.lit(float(v)))
            for c, v in numeric_fill.items() if c in df.columns}
    cols.update({c: F.coalesce(F.col(c).cast("string"), F.lit(v)) for c, v in categorical_fill.items() if c in df.columns})
    return df.withColumns(cols)


def vocabularies(df: DataFrame, columns: Sequence[str]) -> dict[str, list[str]]:
    """Distinct non-null values per column, most frequent first (ties by value).

    One grouped count over the unpivoted columns; only the vocabulary, which
    defines the one-hot schema, reaches the driver.
    """
    if not columns:
        return {}
    long = df.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value"))
                                        for c in columns])))
    rows = (long.filter(F.col("value").isNotNull()).groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
            .orderBy("column", F.desc("n"), "value").limit(MAX_VOCABULARY + 1).collect())
    if len(rows) > MAX_VOCABULARY:
        raise ValueError(f"{', '.join(columns)}: more than {MAX_VOCABULARY} values, too many for one-hot columns")
    out: dict[str, list[str]] = {c: [] for c in columns}
    for r in rows:
        out[r["column"]].append(r["value"])
    return out


def fit_spec(df: DataFrame, feature_columns: Sequence[str], numeric: Sequence[str], categorical: Sequence[str],
             ordinal_column: str | None, onehot_columns: Sequence[str]) -> TransformSpec:
    """Means (G14), modes (G13), ordinal map, one-hot vocabularies, output order."""
    means = df.agg(*[F.avg(F.col(c).cast("double")).alias(c) for c in numeric]).first().asDict() if numeric else {}
    modes = {r["column"]: r["mode"] for r in mode_per_column(df, categorical).collect()} if categorical else {}
    imputed = impute(df, {}, modes)
    vocab = vocabularies(imputed, list(onehot_columns))
    ordinal_map: dict[str, int] = {}
    if ordinal_column:
        cats = sorted(vocabularies(imputed, [ordinal_column])[ordinal_column])
        ordinal_map = {c: i for i, c in enumerate(cats)}
    outputs = []
    for c in feature_columns:
        if c in vocab:
            outputs += [f"{c}_{v}" for v in vocab[c]]
        else:
            outputs.append(c)
    return TransformSpec(list(numeric), {k: float(v) for k, v in means.items()}, list(categorical), modes,
                         ordinal_column, ordinal_map, vocab, outputs)


def apply_spec(df: DataFrame, spec: TransformSpec, keep: Sequence[str] = ()) -> DataFrame:
    """Impute -> ordinal -> one-hot -> conform to the fitted output columns, one projection."""
    # Absent raw column -> null, then imputed
    raw = T.StructType([T.StructField(c, T.StringType()) for c in spec.numeric_columns + spec.categorical_columns])
    base = add_absent_columns(df, raw)
    imp = impute(base, spec.numeric_fill, spec.categorical_fill)
    exprs = {c: F.col(c) for c in spec.numeric_columns}
    if spec.ordinal_column:
        exprs[spec.ordinal_column] = ordinal_encode(spec.ordinal_column, spec.ordinal_map, UNKNOWN_ORDINAL)
    for c, cats in spec.onehot.items():
        for v in cats:
            exprs[f"{c}_{v}"] = F.col(c).cast("string").eqNullSafe(F.lit(v)).cast("long")
    cols = [exprs[c].alias(c) if c in exprs else F.lit(0).alias(c) for c in spec.output_columns]
    return imp.select(*keep, *cols)


def sparse_rows(df: DataFrame, spec: TransformSpec, keep: Sequence[str] = ()) -> DataFrame:
    """Each record as the positions and values of its features that are not zero, in the fitted column order.

    A category is looked up in the fitted vocabulary instead of being compared with every category, so a
    row is as long as its record and not as the vocabulary. Positions are those of the training
    columns: unseen categories have none, columns that the frame lacks are imputed.
    """
    raw = T.StructType([T.StructField(c, T.StringType()) for c in spec.numeric_columns + spec.categorical_columns])
    imp = impute(add_absent_columns(df, raw), spec.numeric_fill, spec.categorical_fill)
    at = {c: i for i, c in enumerate(spec.output_columns)}
    entries = [F.struct(F.lit(at[c]).alias("position"), F.col(c).cast("double").alias("value")) for c in spec.numeric_columns if c in at]
    if spec.ordinal_column in at:
        code = ordinal_encode(spec.ordinal_column, spec.ordinal_map, UNKNOWN_ORDINAL)
        entries.append(F.struct(F.lit(at[spec.ordinal_column]).alias("position"), code.cast("double").alias("value")))
    for c, cats in spec.onehot.items():
        if cats:
            places = F.map_from_arrays(F.array(*[F.lit(v) for v in cats]), F.array(*[F.lit(at[f"{c}_{v}"]) for v in cats]))
            entries.append(F.struct(F.try_element_at(places, F.col(c).cast("string")).alias("position"), F.lit(1.0).alias("value")))
    held = F.array_sort(F.filter(F.array(*entries), lambda e: e["position"].isNotNull() & (e["value"] != 0)))
    return imp.select(*keep, held.alias("__e")).select(*keep, F.col("__e.position").alias("positions"), F.col("__e.value").alias("values"))


def spec_table(spark: SparkSession, spec: TransformSpec) -> DataFrame:
    """The spec as rows: (output_column, position, source_column, role, category, fill_num, fill_text)."""
    rows = []
    for i, oc in enumerate(spec.output_columns):
        src, cat, role = oc, None, "numeric"
        for c, cats in spec.onehot.items():
            for v in cats:
                if oc == f"{c}_{v}":
                    src, cat, role = c, v, "onehot"
        if oc == spec.ordinal_column:
            role = "ordinal"
        rows.append((oc, i, src, role, cat, spec.numeric_fill.get(src), spec.categorical_fill.get(src)))
    return spark.createDataFrame(rows, "output_column string, position int, source_column string, role string, "
                                       "category string, fill_num double, fill_text string")


def unseen_values(df: DataFrame, spec: TransformSpec, columns: Sequence[str]) -> DataFrame:
    """(column, value, n) for values outside the fitted categories (P20)."""
    known = []
    for c in columns:
        if c in spec.onehot:
            known += [(c, v) for v in spec.onehot[c]]
        elif c == spec.ordinal_column:
            known += [(c, v) for v in spec.ordinal_map]
    spark = df.sparkSession
    known_df = spark.createDataFrame(known, "column string, value string")
    long = df.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value"))
                                        for c in columns]))).filter(F.col("value").isNotNull())
    # counted first, so the join sees one row per value; the planner sizes the known list
    counts = long.groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    return counts.join(known_df, ["column", "value"], "left_anti")


def dummies_long(df: DataFrame, key: str, column: str, categories: Sequence[str], sep: str = "_") -> DataFrame:
    """One-hot in long form: (key, dummy_column, indicator) per fixed category."""
    cats = list(categories)
    return df.select(key, F.inline(F.array(*[
        F.struct(F.lit(f"{column}{sep}{c}").alias("dummy_column"),
                 F.col(column).cast("string").eqNullSafe(F.lit(c)).cast("long").alias("indicator")) for c in cats])))
