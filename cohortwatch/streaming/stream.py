"""Structured Streaming operators.

Every stream reads files with an explicit schema, writes through a checkpoint
in the shared folder (exactly-once file sinks, restartable after executor or
driver loss), and uses ``foreachBatch`` only where a sink needs table
semantics (gauges, latest-value tables). Tables that a batch both reads and
replaces are written as new versions, never overwritten in place.
"""

from __future__ import annotations

import logging
import os
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortwatch.operators.clean import row_hash
from cohortwatch.session import shared_path

# Key-hash partitions of a latest table.
LATEST_PARTS = 64


def file_stream(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet",
                files_per_batch: int | None = 1) -> DataFrame:
    """Streaming scan of a folder; ``files_per_batch`` files make one micro-batch."""
    reader = spark.readStream.schema(schema).format(fmt)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)


def stage_by_day(df: DataFrame, ts: str, path: str) -> str:
    """Write ``df`` as one file per day (``day=...`` folders) to feed a file stream."""
    day = F.to_date(F.col(ts).cast("timestamp"))
    (df.withColumn("day", day).repartition("day").write.mode("overwrite").partitionBy("day").parquet(path))
    date_files(df.sparkSession, path)
    return path


def date_files(spark: SparkSession, path: str) -> None:
    """Give the staged files modification times in the order of their names, which is the order a file stream takes them in."""
    folder, fs = _hadoop(spark, path)
    found, files = [], fs.listFiles(folder, True)
    while files.hasNext():
        found.append(files.next().getPath())
    start = int(time.time() * 1000) - 1000 * len(found)
    for i, file in enumerate(sorted(found, key=lambda f: f.toString())):  # one file a day
        fs.setTimes(file, start + 1000 * i, -1)


def run_available(writer, name: str | None = None) -> None:
    """Run a stream over everything available now, then stop (batch-like, restartable)."""
    q = writer.trigger(availableNow=True).start()
    q.awaitTermination()


def append_to_files(stream: DataFrame, path: str, checkpoint: str, fmt: str = "parquet") -> None:
    """Append-only file sink with a checkpoint: each row lands once even after restarts."""
    run_available(stream.writeStream.format(fmt).outputMode("append").option("path", path)
                  .option("checkpointLocation", checkpoint))


def foreach_batch(stream: DataFrame, fn: Callable[[DataFrame, int], None], checkpoint: str,
                  mode: str = "append") -> None:
    """Run ``fn(batch_df, batch_id)`` per micro-batch (V05: the result callback)."""
    run_available(stream.writeStream.outputMode(mode).foreachBatch(fn).option("checkpointLocation", checkpoint))


def running_totals(stream: DataFrame, keys, value: str, table_path: str, checkpoint: str) -> None:
    """Streaming aggregate in complete mode; each batch replaces a versioned totals table."""
    agg = stream.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.sum(value).alias("total"))

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(os.path.join(table_path, f"v={batch_id:08d}"))
        prune_versions(batch.sparkSession, table_path)

    foreach_batch(agg, write, checkpoint, mode="complete")


def batch_path(path: str, batch_id: int) -> str:
    """Folder of one micro-batch inside a table; a replayed batch overwrites its own folder."""
    return os.path.join(path, f"b={batch_id:012d}")


def read_batches(spark: SparkSession, path: str) -> DataFrame:
    """All rows that batches have written under ``path``, without the folder's own column."""
    return spark.read.parquet(path).drop("b")


def complete_versions(spark: SparkSession, table_path: str, before: int | None = None) -> list[str]:
    """``v=...`` folders whose write was committed (they hold ``_SUCCESS``), oldest first."""
    found = sorted(p for p in _list_dirs(spark, table_path) if os.path.basename(p).startswith("v="))
    if before is not None:
        found = [p for p in found if int(os.path.basename(p)[2:]) < before]
    return [p for p in found if path_exists(spark, os.path.join(p, "_SUCCESS"))]


def latest_version(spark: SparkSession, table_path: str) -> DataFrame:
    """Read the newest complete ``v=...`` version of a versioned table."""
    return spark.read.parquet(complete_versions(spark, table_path)[-1])


def prune_versions(spark: SparkSession, table_path: str, keep: int = 2) -> None:
    """Remove all but the newest ``keep`` complete versions (readers may still hold the one before)."""
    for old in complete_versions(spark, table_path)[:-keep]:
        remove_path(spark, old)


def _hadoop(spark: SparkSession, path: str):
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hpath, hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    hpath, fs = _hadoop(spark, path)
    return fs.exists(hpath)


def remove_path(spark: SparkSession, path: str) -> None:
    hpath, fs = _hadoop(spark, path)
    fs.delete(hpath, True)


def newest_row(rows: DataFrame, key: str, ts: str) -> DataFrame:
    """Newest row per key by ``ts``; equal times are settled by a hash of the other columns, so reruns agree."""
    cols = [c for c in rows.columns if c != key]
    order = F.struct(F.col(ts), row_hash(rows, [c for c in cols if c != ts]).alias("hash"))
    return rows.groupBy(key).agg(F.max_by(F.struct(*cols), order).alias("r")).select(key, "r.*")


def _list_dirs(spark: SparkSession, path: str) -> list[str]:
    hpath, fs = _hadoop(spark, path)
    if not fs.exists(hpath):
        return []
    return [str(s.getPath().toString()) for s in fs.listStatus(hpath) if s.isDirectory()]


def batch_gauges(stream: DataFrame, ts: str, flag: str, samples_path: str, checkpoint: str,
                 labels: dict | None = None) -> None:
    """Per micro-batch: rows scored and the positive ratio as metric samples.

    Each batch writes (ts, name, labels, value) rows to its own folder, so a replay
    replaces them (read with ``read_batches``). The sample time is the latest event time
    of the batch, so the current value of a gauge is ``max_by(value, ts)`` whatever
    order the batches ran in.
    """
    lab = F.create_map(*[x for k, v in (labels or {}).items() for x in (F.lit(k), F.lit(v))]) if labels else \
        F.create_map().cast("map<string,string>")

    def publish(batch: DataFrame, batch_id: int) -> None:
        stats = batch.agg(F.max(F.col(ts).cast("timestamp")).alias("ts"), F.count(F.lit(1)).alias("n"),
                          F.avg(F.col(flag).cast("double")).alias("ratio"))
        samples = stats.filter(F.col("n") > 0).select("ts", F.inline(F.array(
            F.struct(F.lit("rows_scored").alias("name"), F.col("n").cast("double").alias("value")),
            F.struct(F.lit("predicted_positive_ratio").alias("name"), F.col("ratio").alias("value")))))
        samples.select("ts", "name", lab.alias("labels"), "value").write.mode("overwrite").parquet(batch_path(samples_path, batch_id))

    foreach_batch(stream, publish, checkpoint)


class LatestTable:
    """Newest row per key in key-hash partitions; a version rewrites the partitions that it touches only.

    ``data/v=<version>/part=<p>`` holds what a version wrote, and ``manifest/v=<version>`` names for
    every partition the version that holds it now. The manifest is written last and
    makes the version final: a version that failed or is replayed starts from the manifest before it
    and overwrites its own folders. Folders that none of the last two manifests names are removed.
    """

    def __init__(self, spark: SparkSession, path: str, key: str, ts: str, parts: int = LATEST_PARTS):
        self.spark, self.key, self.ts, self.parts = spark, key, ts, parts
        self.data, self.manifests = os.path.join(path, "data"), os.path.join(path, "manifest")

    def _folder(self, version: int, part: int | None = None) -> str:
        folder = os.path.join(self.data, f"v={version:012d}")
        return folder if part is None else os.path.join(folder, f"part={part}")

    def manifest(self, before: int | None = None) -> dict[int, int]:
        """Partition to version, of the newest final version (before ``before``); one entry a partition."""
        found = complete_versions(self.spark, self.manifests, before)
        return {r["part"]: r["version"] for r in self.spark.read.parquet(found[-1]).collect()} if found else {}

    def merge(self, rows: DataFrame, version: int) -> set[int]:
        """Take in ``rows`` as version ``version``; gives the partitions that were rewritten."""
        rows = rows.withColumn("part", F.pmod(F.xxhash64(self.key), F.lit(self.parts)).cast("int"))
        touched = {r["part"] for r in rows.select("part").distinct().collect()}  # at most ``parts``
        held = self.manifest(before=version)
        old = [self._folder(held[p], p) for p in sorted(touched & held.keys())]
        merged = rows.drop("part")
        if old:
            merged = merged.unionByName(self.spark.read.schema(merged.schema).parquet(*old))
        newest = newest_row(merged, self.key, self.ts).withColumn("part", F.pmod(F.xxhash64(self.key), F.lit(self.parts)).cast("int"))
        remove_path(self.spark, self._folder(version))
        if touched:
            # one shuffle: the newest rows of a key are already where its partition is written
            newest.repartition("part").write.partitionBy("part").parquet(self._folder(version))
        now = {**held, **dict.fromkeys(touched, version)}
        (self.spark.createDataFrame(sorted(now.items()), "part int, version long").coalesce(1)
         .write.mode("overwrite").parquet(os.path.join(self.manifests, f"v={version:012d}")))
        self._prune()
        return touched

    def _prune(self) -> None:
        finals = complete_versions(self.spark, self.manifests)
        named = {(r["version"], r["part"]) for f in finals[-2:] for r in self.spark.read.parquet(f).collect()}
        for old in finals[:-2]:
            remove_path(self.spark, old)
        newest = int(os.path.basename(finals[-1])[2:])
        for folder in _list_dirs(self.spark, self.data):
            version = int(os.path.basename(folder)[2:])
            if version > newest:
                continue
            parts = _list_dirs(self.spark, folder)
            dead = [p for p in parts if (version, int(os.path.basename(p)[5:])) not in named]
            for p in [folder] if len(dead) == len(parts) else dead:
                remove_path(self.spark, p)

    def read(self) -> DataFrame:
        """The newest row of every key."""
        return self.spark.read.parquet(*[self._folder(v, p) for p, v in sorted(self.manifest().items())])


def push_latest(stream: DataFrame, key: str, ts: str, history_path: str, latest_path: str, checkpoint: str, parts: int = LATEST_PARTS) -> None:
    """Each batch: its rows to history; latest = newest row per key over old latest + batch.

    History holds one folder per batch (read with ``read_batches``); the latest table is a
    ``LatestTable`` whose version is the batch. A replayed batch rewrites both and changes
    nothing else.
    """
    def push(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(batch_path(history_path, batch_id))
        LatestTable(batch.sparkSession, latest_path, key, ts, parts).merge(batch, batch_id)

    foreach_batch(stream, push, checkpoint)


def materialize_incremental(spark: SparkSession, source: DataFrame, key: str, ts: str, end_ts: str,
                            control_path: str, latest_path: str, parts: int = LATEST_PARTS) -> int:
    """Merge rows with low mark < ts <= end_ts into the latest table, then move the mark.

    Returns the number of rows taken in this run. The control table holds one
    row per run (end mark); the latest table is a ``LatestTable`` like that of ``push_latest``.
    """
    runs = _list_dirs(spark, control_path)
    low = None
    if runs:
        low = spark.read.parquet(control_path).agg(F.max("end_ts")).first()[0]
    end = F.lit(end_ts).cast(source.schema[ts].dataType)
    new = source.filter(F.col(ts) <= end)
    if low is not None:
        new = new.filter(F.col(ts) > F.lit(low).cast(source.schema[ts].dataType))
    n_new = new.count()
    # the control run that follows a version makes it final; a version without one is written anew
    LatestTable(spark, latest_path, key, ts, parts).merge(new, len(runs))
    (spark.createDataFrame([(end_ts, n_new)], "end_ts string, n_rows long")
     .withColumn("end_ts", F.col("end_ts").cast(source.schema[ts].dataType))
     .write.mode("overwrite").parquet(os.path.join(control_path, f"run={len(runs):08d}")))
    return n_new


def score_and_log(stream: DataFrame, score: Callable[[DataFrame], DataFrame], scores_path: str, log_path: str, checkpoint: str,
                  log: Callable[[DataFrame, str], None] | None = None) -> None:
    """Each batch's scores and their audit log, two sinks with commit marks of their own.

    Scores are written first and must succeed. A log that fails does not stop the stream: batches whose
    scores are committed and whose log is not are tried again, oldest first, after every
    later batch and when the stream starts, from the written scores. ``log(rows, path)`` writes the
    log of one batch (default: Parquet). Both tables are read with ``read_batches``.
    """
    write = log or (lambda rows, path: rows.write.mode("overwrite").parquet(path))

    def committed(spark: SparkSession, path: str) -> set[str]:
        return {os.path.basename(p) for p in _list_dirs(spark, path) if path_exists(spark, os.path.join(p, "_SUCCESS"))}

    def catch_up(spark: SparkSession) -> None:
        for b in sorted(committed(spark, scores_path) - committed(spark, log_path)):
            try:
                write(spark.read.parquet(os.path.join(scores_path, b)), os.path.join(log_path, b))
            except Exception as e:  # noqa: BLE001 - any failure of the log sink waits for the next batch
                logging.getLogger(__name__).warning("log of batch %s failed, to be tried again: %s", b, e)
                return

    def both(batch: DataFrame, batch_id: int) -> None:
        score(batch).write.mode("overwrite").parquet(batch_path(scores_path, batch_id))
        catch_up(batch.sparkSession)

    catch_up(stream.sparkSession)
    foreach_batch(stream, both, checkpoint)


def new_stream_dirs(spark: SparkSession, name: str) -> dict[str, str]:
    """Fresh source/sink/checkpoint folders under the shared checkpoint folder."""
    base = shared_path(spark, "streams", name)
    return {k: os.path.join(base, k) for k in ("source", "sink", "checkpoint", "history", "latest", "control")}
