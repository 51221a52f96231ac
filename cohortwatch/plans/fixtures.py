"""Test fixtures over the given tables.

The clinical roles (encounter, patient, codes, target) are mapped onto the
TPC-H-like tables with plain column expressions. Each fixture is one SQL text
that Spark SQL and DuckDB both run unchanged, so the Spark queries and their
DuckDB oracles start from identical inputs. Every fixture reads a whole table.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def register_tables(spark: SparkSession, sf_dir: str, names=None) -> None:
    for t in names or TABLES:
        read_table(spark, sf_dir, t).createOrReplaceTempView(t)


# Raw encounters from `orders`: one row per order; patient = customer.
# Placeholders '?' and nulls are written alike in both engines.
ENCOUNTERS_SQL = """
SELECT
  o_orderkey AS encounter_id,
  o_custkey AS patient_nbr,
  CASE WHEN o_orderkey % 9 = 0 THEN '?'
       WHEN o_orderstatus = 'F' THEN 'Caucasian'
       WHEN o_orderstatus = 'O' THEN 'AfricanAmerican'
       ELSE 'Hispanic' END AS race,
  CASE WHEN o_orderkey % 13 = 0 THEN 'Unknown/Invalid'
       WHEN o_orderkey % 17 = 0 THEN '?'
       WHEN o_custkey % 2 = 0 THEN 'Female' ELSE 'Male' END AS gender,
  '[' || CAST(10 * (o_custkey % 11) AS STRING) || '-'
      || CAST(10 * (o_custkey % 11) + 10 AS STRING) || ')' AS age,
  CASE WHEN o_orderkey % 5 = 0 THEN '?' ELSE 'w' || CAST(o_custkey % 3 AS STRING) END AS weight,
  '?' AS payer_code,
  CASE WHEN o_orderkey % 7 = 0 THEN '?'
       WHEN o_custkey % 97 = 0 THEN 'Rare' || CAST(o_custkey % 5 AS STRING)
       ELSE substr(o_orderpriority, 3) END AS medical_specialty,
  CAST(substr(o_orderpriority, 1, 1) AS INT) AS admission_type_id,
  CASE WHEN o_orderkey % 29 = 0 THEN NULL ELSE CAST(o_orderkey % 30 AS INT) END AS discharge_disposition_id,
  CAST(o_custkey % 26 AS INT) AS admission_source_id,
  CAST(1 + o_orderkey % 14 AS BIGINT) AS time_in_hospital,
  CAST(1 + CAST(floor(o_totalprice) AS BIGINT) % 132 AS BIGINT) AS num_lab_procedures,
  CAST(o_orderkey % 7 AS BIGINT) AS num_procedures,
  CAST(1 + o_custkey % 81 AS BIGINT) AS num_medications,
  CAST(o_orderkey % 4 AS BIGINT) AS number_outpatient,
  CAST(o_custkey % 3 AS BIGINT) AS number_emergency,
  CAST(o_orderkey % 5 AS BIGINT) AS number_inpatient,
  CAST(1 + o_orderkey % 16 AS BIGINT) AS number_diagnoses,
  CASE WHEN o_orderkey % 31 = 0 THEN NULL
       WHEN o_orderkey % 11 = 0 THEN 'V' || CAST(o_custkey % 90 AS STRING)
       WHEN o_orderkey % 23 = 0 THEN 'E' || CAST(o_custkey % 900 AS STRING)
       WHEN o_orderkey % 37 = 0 THEN 'x' || CAST(o_custkey % 9 AS STRING)
       WHEN o_orderkey % 3 = 0 THEN CAST(o_custkey % 1000 AS STRING) || '.' || CAST(o_orderkey % 10 AS STRING)
       ELSE CAST((o_custkey * 7 + o_orderkey) % 1000 AS STRING) END AS diag_1,
  CASE WHEN o_orderkey % 41 = 0 THEN NULL
       WHEN o_orderstatus = 'F' THEN 'NO'
       WHEN o_orderstatus = 'O' THEN '>30' ELSE '<30' END AS readmitted,
  o_orderdate AS admit_ts
FROM orders
"""

# Diagnosis-like codes over `lineitem` (F01): supplementary 'V', nulls, numbers.
LINE_CODES_SQL = """
SELECT l_orderkey, l_linenumber,
  CASE WHEN l_linenumber = 7 THEN 'V' || CAST(l_partkey % 100 AS STRING)
       WHEN l_linenumber = 6 THEN NULL
       WHEN l_linenumber = 5 THEN CAST(l_partkey % 1000 AS STRING) || '.' || CAST(l_suppkey % 10 AS STRING)
       WHEN l_linenumber = 4 AND l_partkey % 5 = 0 THEN 'E' || CAST(l_partkey % 1000 AS STRING)
       WHEN l_linenumber = 4 AND l_partkey % 5 = 1 THEN ' ' || CAST(l_partkey % 1000 AS STRING) || ' '
       WHEN l_linenumber = 4 AND l_partkey % 5 = 2 THEN CAST(l_partkey % 1000 AS STRING) || 'd'
       ELSE CAST(l_partkey % 1000 AS STRING) END AS code
FROM lineitem
"""

# Binary-target view of `lineitem` for profiling: target = returned.
LINE_TARGET_SQL = """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
  l_quantity, l_extendedprice, l_discount + 0.0 AS l_discount, l_tax + 0.0 AS l_tax,
  l_returnflag, l_linestatus,
  CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS target
FROM lineitem
"""

# Scored rows: label = returned, score = 10 x discount (11 tied values).
SCORED_SQL = """
SELECT l_orderkey, l_linenumber,
  CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS label,
  CAST(round((l_discount + 0.0) * 10, 6) AS DOUBLE) AS score
FROM lineitem
"""


def fixture(spark: SparkSession, sf_dir: str, sql: str, tables=None) -> DataFrame:
    register_tables(spark, sf_dir, tables)
    return spark.sql(sql)


def encounters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixture(spark, sf_dir, ENCOUNTERS_SQL, ["orders"])


def line_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixture(spark, sf_dir, LINE_CODES_SQL, ["lineitem"])


def line_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixture(spark, sf_dir, LINE_TARGET_SQL, ["lineitem"])


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixture(spark, sf_dir, SCORED_SQL, ["lineitem"])
