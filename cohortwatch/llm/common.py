"""Small helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes
import gc
import os
from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from cohortwatch.session import cut_lineage, shared_path

# Rows of a keyed table that may be broadcast; such tables have a handful of narrow columns.
BROADCAST_ROWS = 50_000
SALTS = 16
MAP_ROWS = 2048


PACKAGE_HOME = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def importable(spark: SparkSession) -> None:
    """Let Python workers import this package from the driver's path, where that path exists.

    On a cluster without a shared code folder the package goes to the executors as
    any other, by --py-files or in their image.
    """
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if PACKAGE_HOME not in paths:
        env["PYTHONPATH"] = os.pathsep.join([PACKAGE_HOME, *paths])


def release_memory() -> None:
    """Give what a finished task has freed back to the system: Python workers live on beside the next stage's."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def text_udf(make: Callable[[pd.Series], pd.Series], returns: str):
    """A pandas UDF of one text column that releases its memory at the end of a task."""
    @F.pandas_udf(returns)
    def mapped(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for text in texts:
            parts = [make(text.iloc[at:at + MAP_ROWS]) for at in range(0, len(text), MAP_ROWS)]
            yield parts[0] if len(parts) == 1 else pd.concat(parts)
        release_memory()

    return mapped


def map_arrow(df: DataFrame, make: Callable[[pa.RecordBatch], dict], schema: str, done: Callable[[], None] | None = None) -> DataFrame:
    """``mapInArrow`` with ``make`` giving the columns of each batch as lists or arrays.

    Arrow carries null ids and 64-bit values unchanged, which pandas would not. Batches
    are taken in slices of MAP_ROWS rows, which bounds what a worker holds of long texts.
    ``done`` runs at the end of a task: Python workers live on, and so would their caches.
    """
    importable(df.sparkSession)
    arrow = to_arrow_schema(StructType.fromDDL(schema))

    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, MAP_ROWS):
                made = make(batch.slice(at, MAP_ROWS))
                yield pa.RecordBatch.from_arrays([column(made[f.name], f.type) for f in arrow], schema=arrow)
        if done:
            done()
        release_memory()

    return df.mapInArrow(mapped, schema)


def column(values, kind: pa.DataType) -> pa.Array:
    if isinstance(values, pa.Array):
        return values if values.type == kind else values.cast(kind)
    return pa.array(values, kind)


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*columns)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a table under the cluster's shared folder and read it back."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def join_keyed(df: DataFrame, keyed: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join ``df`` with ``keyed`` (narrow, one row per key) without gathering a hot key.

    ``keyed`` is cut and counted; up to ``BROADCAST_ROWS`` rows it is broadcast,
    beyond that each of its rows is copied to ``SALTS`` salts and ``df`` is dealt
    over them, so a key with a third of the rows meets several tasks.
    """
    keyed = cut_lineage(keyed)
    if keyed.count() <= BROADCAST_ROWS:
        return df.join(F.broadcast(keyed), keys, how)
    salted = keyed.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    dealt = df.withColumn("__salt", F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)).cast("int"))
    return dealt.join(salted, [*keys, "__salt"], how).drop("__salt")
