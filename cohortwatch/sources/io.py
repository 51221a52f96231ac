"""Sources and sinks.

Reads always take an explicit schema (no inference pass over the data);
writes go to caller-given paths, which on a cluster are in shared storage.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Text cells that mean "missing" on a CSV read (the default NA
# spellings of the common Python CSV reader).
NA_TOKENS = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
             "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null"]
# ---------------------------------------------------------------------------


def csv_text(spark: SparkSession, path: str, schema: T.StructType, **options) -> DataFrame:
    """A headered CSV as text columns under the names of its own header.

    The header (one line) gives the names, so files may hold the columns in any order and
    more than asked for; a column of ``schema`` that the header lacks is an error. Files of
    one read must agree on the header (``enforceSchema`` off: Spark checks each).
    """
    names = spark.read.options(header=True, **options).csv(path).columns
    absent = [f.name for f in schema.fields if f.name not in names]
    if absent:
        raise ValueError(f"{path}: the header lacks {', '.join(absent)}")
    text = T.StructType([T.StructField(n, T.StringType(), True) for n in names])
    return spark.read.options(header=True, enforceSchema=False, **options).schema(text).csv(path)


def typed_cells(schema: T.StructType, na_tokens: Sequence[str] = NA_TOKENS) -> list:
    """Text columns -> the schema's types by name, every NA spelling -> null."""
    tokens = list(na_tokens)
    return [F.when(F.col(f"`{f.name}`").isin(tokens), F.lit(None)).otherwise(F.col(f"`{f.name}`")).cast(f.dataType).alias(f.name)
            for f in schema.fields]


def read_csv(spark: SparkSession, path: str, schema: T.StructType, na_tokens: Sequence[str] = NA_TOKENS) -> DataFrame:
    """Headered CSV, columns by name, with a fixed schema; every NA spelling -> null."""
    return csv_text(spark, path, schema).select(*typed_cells(schema, na_tokens))


def write_csv(df: DataFrame, path: str) -> None:
    """Overwrite, header, no index."""
    df.write.mode("overwrite").option("header", True).csv(path)


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite", partition_by: Sequence[str] = ()) -> None:
    """K02, K07."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def write_if_absent(df: DataFrame, path: str) -> None:
    """Materialise once; later calls leave the table as it is."""
    df.write.mode("ignore").parquet(path)


def load_or_materialise(spark: SparkSession, build, path: str) -> DataFrame:
    """Read the table at ``path``; build and write it first if absent."""
    write_if_absent(build(), path)
    return spark.read.parquet(path)


def read_scenario_files(spark: SparkSession, pattern: str, schema: T.StructType, name_col: str = "scenario",
                        fmt: str = "csv") -> DataFrame:
    """One read of a file glob; the scenario name is the file's stem (or its folder key).

    The name comes from the hidden ``_metadata.file_path`` column, so a filter
    on it happens in the scan rather than in a driver loop over files.
    """
    if fmt == "csv":
        df, cells = csv_text(spark, pattern, schema, recursiveFileLookup=True), typed_cells(schema)
    else:
        df = spark.read.schema(schema).option("recursiveFileLookup", True).format(fmt).load(pattern)
        cells = [F.col(f"`{f.name}`") for f in schema.fields]
    path = F.col("_metadata.file_path")
    stem = F.regexp_extract(path, r"([^/=]+)=([^/]+)/[^/]+$", 2)
    base = F.regexp_extract(path, r"([^/]+?)(\.[^./]*)?$", 1)
    return df.select(*cells, F.when(stem != "", stem).otherwise(base).alias(name_col))


def write_json_document(df: DataFrame, path: str) -> None:
    """A small record (one row) as one JSON document."""
    df.coalesce(1).write.mode("overwrite").json(path)


def read_json_document(spark: SparkSession, path: str, schema: T.StructType | None = None,
                       multi_line: bool = True) -> DataFrame:
    """JSON documents (one per file, may span lines), or JSON lines with ``multi_line=False``."""
    r = spark.read.option("multiLine", multi_line)
    if schema is not None:
        r = r.schema(schema)
    return r.json(path)


def parse_records(df: DataFrame, column: str, record_schema: T.StructType, field: str = "records") -> DataFrame:
    """Text holding ``{"records": [...]}`` -> one row per record; missing fields null, unknown dropped."""
    wrapper = T.StructType([T.StructField(field, T.ArrayType(record_schema), True)])
    parsed = df.select(F.from_json(F.col(column), wrapper).alias("__doc"))
    return parsed.select(F.explode_outer(f"__doc.{field}").alias("__r")).select("__r.*")


def write_report_tables(tables: dict[str, DataFrame], folder: str) -> None:
    """Report rows as tables (Parquet per table; small ones also as CSV)."""
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{folder}/{name}")
