"""Cleaning operators.

First-per-key and latest-per-key are aggregations (``min``/``max`` over a
struct whose leading fields are the ordering), not ``row_number`` windows: the
aggregate is combined map-side before the shuffle, so a key that holds a third
of all rows is reduced in every map task instead of landing whole in one task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortwatch.functions.codes import not_equal_keep_null, not_in_keep_null
from cohortwatch.functions.values import to_number


def has_order(dtype: T.DataType) -> bool:
    """Whether values of the type can be compared (maps cannot, nor what holds them)."""
    if isinstance(dtype, T.StructType):
        return all(has_order(f.dataType) for f in dtype.fields)
    if isinstance(dtype, T.ArrayType):
        return has_order(dtype.elementType)
    return not isinstance(dtype, (T.MapType, T.VariantType))


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def numeric_columns(df: DataFrame) -> list[str]:
    """Columns of a numeric type."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def placeholder_to_null(df: DataFrame, token: str = "?", columns: Sequence[str] | None = None) -> DataFrame:
    """Whole-cell ``token`` -> null in every string column."""
    cols = list(columns) if columns is not None else string_columns(df)
    if not cols:
        return df
    return df.withColumns({c: F.when(F.col(c) == token, F.lit(None)).otherwise(F.col(c)) for c in cols})


def drop_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """P02."""
    return df.drop(*columns)


def fill_missing(df: DataFrame, fills: Mapping[str, object]) -> DataFrame:
    """Null -> literal, per column."""
    return df.fillna(dict(fills))


def recode_codes(df: DataFrame, recodes: Mapping[str, Sequence], marker=-1) -> DataFrame:
    """Values in a code set -> one marker, per column."""
    return df.withColumns({
        c: F.when(F.col(c).isin(list(codes)), F.lit(marker)).otherwise(F.col(c)).cast(df.schema[c].dataType)
        for c, codes in recodes.items()
    })


def anti_filter_keep_null(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    """Drop rows whose value is in the list; nulls stay."""
    return df.filter(not_in_keep_null(column, values))


def not_equal_filter_keep_null(df: DataFrame, column: str, value) -> DataFrame:
    """Drop rows equal to ``value``; nulls stay."""
    return df.filter(not_equal_keep_null(column, value))


def row_hash(df: DataFrame, columns: Sequence[str]):
    """A hash of those of the columns that have an order, to settle ties."""
    return F.xxhash64(F.lit(0), *[F.col(c) for c in columns if has_order(df.schema[c].dataType)])


def first_per_key(df: DataFrame, key: str | Sequence[str], order: str | Sequence[str],
                  descending: bool = False) -> DataFrame:
    """One row per key: the smallest (or largest) by ``order``, nulls last.

    pandas' ``sort_values(order).drop_duplicates(key, keep='first')``: null keys
    form one group, null ordering values sort last. Expressed as a
    partial+final ``min_by``/``max_by``, so skewed keys are combined map-side. A hash of the
    other columns breaks ties (map columns, which have none, aside), so that a row is in the
    buffer once and reruns agree; the row itself is only carried and may hold any type.
    """
    keys = [key] if isinstance(key, str) else list(key)
    orders = [order] if isinstance(order, str) else list(order)
    rest = [c for c in df.columns if c not in keys]
    if descending:
        # largest first, nulls still last: null flag sorts lowest under max
        lead = [F.col(o).isNotNull().alias(f"__nn{i}") for i, o in enumerate(orders)]
        agg = F.max_by
    else:
        lead = [F.col(o).isNull().alias(f"__isnull{i}") for i, o in enumerate(orders)]
        agg = F.min_by
    ordered = []
    for i, o in enumerate(orders):
        ordered += [lead[i], F.col(o).alias(f"__ord{i}")]
    tie = row_hash(df, rest).alias("__tie")
    row = F.struct(*[F.col(c) for c in rest])
    out = df.groupBy(*keys).agg(agg(row, F.struct(*ordered, tie)).alias("__row"))
    return out.select(*[F.col(k) for k in keys], *[F.col("__row")[c].alias(c) for c in rest]).select(*df.columns)


def conform_columns(df: DataFrame, expected: Sequence[str], fill=0) -> DataFrame:
    """Add missing expected columns as ``fill``, drop extras, fix the order."""
    have = set(df.columns)
    return df.select(*[F.col(c) if c in have else F.lit(fill).alias(c) for c in expected])


def add_absent_columns(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Absent raw columns -> typed nulls."""
    have = set(df.columns)
    return df.withColumns({f.name: F.lit(None).cast(f.dataType) for f in schema.fields if f.name not in have})


def coerce_numeric(df: DataFrame, columns: Sequence[str], to: str = "double") -> DataFrame:
    """Bad values -> null (P10)."""
    return df.withColumns({c: to_number(c, to) for c in columns})


def clean_pipeline(raw: DataFrame, *, placeholder: str, drop: Sequence[str],
                   fills: Mapping[str, object], recodes: Mapping[str, Sequence], marker,
                   exclude_column: str, exclude_codes: Sequence,
                   invalid_column: str, invalid_value, key: str, order: str) -> DataFrame:
    """Placeholder -> null, drop, fill, recode, anti-filter, not-equal, first per key."""
    df = placeholder_to_null(raw, placeholder)
    df = drop_columns(df, drop)
    df = fill_missing(df, fills)
    df = recode_codes(df, recodes, marker)
    df = anti_filter_keep_null(df, exclude_column, exclude_codes)
    df = not_equal_filter_keep_null(df, invalid_column, invalid_value)
    return first_per_key(df, key, order)


def stamp(df: DataFrame, column: str, ts) -> DataFrame:
    """Load-time stamp passed in by the caller, for repeatable runs (P13); a zone-free timestamp."""
    return df.withColumn(column, F.lit(ts).cast("timestamp_ntz"))


def swap_columns(df: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """Swap column pairs in one projection."""
    m = {}
    for a, b in pairs:
        m[a], m[b] = b, a
    return df.select(*[F.col(m.get(c, c)).cast(df.schema[c].dataType).alias(c) for c in df.columns])

