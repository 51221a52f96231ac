"""Live count-based rolling drift monitor for a stream.

Used as the ``foreachBatch`` function of a streaming query. Per micro-batch:

1. rows get arrival numbers after the rows seen so far (order inside the
   batch by ``order_col``) and go to the batch's own folder of a buffer table,
   partitioned by block of ``window`` rows, so a window read prunes to two blocks;
2. when due (>= ``min_new`` rows since the last check and >= ``min_window``
   rows buffered) the drift verdict of the last ``window`` rows is written to the
   batch's folder of the verdict table and the counter resets;
3. the control row (rows seen, rows since the last check) is written as the batch's
   version, last: it makes the batch final. Buffer folders that no window can reach
   any more are removed.

A batch that failed at any step starts from the control version before it and
overwrites its own folders, so a replay counts no row twice. Batches run one after
another, so the "analysis already running" case of a threaded monitor cannot occur.
All state lives in the shared folder.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cohortwatch.operators import drift as D
from cohortwatch.operators import drift_windows as W
from cohortwatch.operators.scan import ordered_scan
from cohortwatch.streaming.rolling import drift_of_windows
from cohortwatch.streaming.stream import _list_dirs, batch_path, complete_versions, path_exists, read_batches, remove_path


def window_counts(rows: DataFrame, numeric, categorical) -> DataFrame:
    """One block: the value counts of the whole window."""
    counts = D.long_form(rows, numeric, categorical).groupBy(*W.KEYS).agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("__seq", F.lit(0).cast("long"))


class RollingDriftMonitor:
    def __init__(self, reference: DataFrame, numeric, categorical, folder: str, order_col: str,
                 window: int = 3000, min_new: int = 600, min_window: int = 2000):
        self.reference = reference
        self.numeric, self.categorical = list(numeric), list(categorical)
        self.folder = folder
        self.order_col = order_col
        self.window, self.min_new, self.min_window = window, min_new, min_window

    def _path(self, name: str) -> str:
        return os.path.join(self.folder, name)

    def _control(self, spark):
        versions = complete_versions(spark, self._path("control"))
        if not versions:
            return 0, 0, -1
        r = spark.read.parquet(versions[-1]).first()
        return int(r["rows_seen"]), int(r["rows_since"]), int(r["batch_id"])

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        seen, since, last_batch = self._control(spark)
        if batch_id <= last_batch:        # replayed batch after a restart: already applied
            return
        n = batch.count()
        if n:
            # number the batch rows after the rows seen so far (bucketed scan: no single-task window)
            numbered = ordered_scan(batch.withColumn("__one", F.lit(1)), [], self.order_col, ["__one"], most=n)
            numbered = numbered.withColumn("__seq", F.lit(seen) + F.col("cum___one") - 1).drop(
                "__one", "cum___one", "next_value")
            numbered = numbered.withColumn("__block", F.floor(F.col("__seq") / self.window))
            numbered.write.mode("overwrite").partitionBy("__block").parquet(batch_path(self._path("buffer"), batch_id))
        elif path_exists(spark, batch_path(self._path("buffer"), batch_id)):
            remove_path(spark, batch_path(self._path("buffer"), batch_id))
        seen, since = seen + n, since + n
        due = since >= self.min_new and min(seen, self.window) >= self.min_window
        if due:
            lo = seen - self.window
            buf = read_batches(spark, self._path("buffer")).filter(
                (F.col("__block") >= F.floor(F.lit(max(lo, 0)) / self.window)) & (F.col("__seq") >= lo))
            rows = buf.select("__seq", *self.numeric, *self.categorical)
            table = drift_of_windows(
                self.reference, rows, spark.range(1).select(F.col("id").alias("check_id")), lambda df: df.withColumn("check_id", F.lit(0).cast("long")),
                self.numeric, self.categorical, lambda num, cat: window_counts(rows, num, cat), self._reference_counts(spark))
            verdict = D.dataset_verdict(table, "check_id").select(
                F.lit(batch_id).cast("long").alias("batch_id"), F.lit(seen).cast("long").alias("rows_seen"),
                "n_columns", "n_drifted", "drift_share", "dataset_drift", "drifted_columns")
            verdict.write.mode("overwrite").parquet(batch_path(self._path("verdicts"), batch_id))
            since = 0
        (spark.createDataFrame([(batch_id, seen, since, due)], "batch_id long, rows_seen long, rows_since long, "
                                                               "checked boolean")
         .write.mode("overwrite").parquet(os.path.join(self._path("control"), f"v={batch_id:08d}")))
        self._prune(spark, seen)

    def _reference_counts(self, spark) -> DataFrame:
        """Value counts of the whole reference, counted by the first check and kept."""
        path = self._path("reference")
        if not path_exists(spark, os.path.join(path, "_SUCCESS")):
            W.value_counts(self.reference, self.numeric, self.categorical).write.mode("overwrite").parquet(path)
        return spark.read.parquet(path)

    def _prune(self, spark, seen: int) -> None:
        """Remove the buffer folders of batches whose last row lies before any later window."""
        folders = sorted(_list_dirs(spark, self._path("buffer")))
        if len(folders) < 2:
            return
        done = spark.read.parquet(self._path("control")).where(F.col("rows_seen") <= seen - self.window)
        last = done.agg(F.max("batch_id")).first()[0]
        for folder in folders if last is not None else []:
            if int(os.path.basename(folder)[2:]) <= last:
                remove_path(spark, folder)

    VERDICT_SCHEMA = ("batch_id long, rows_seen long, n_columns long, n_drifted long, drift_share double, "
                      "dataset_drift boolean, drifted_columns string")

    def verdicts(self, spark) -> DataFrame:
        """Verdict rows so far; empty (typed) while no check has been due."""
        if not path_exists(spark, self._path("verdicts")):
            return spark.createDataFrame([], self.VERDICT_SCHEMA)
        return read_batches(spark, self._path("verdicts"))

    def states(self, spark) -> DataFrame:
        """State after every batch from the control versions and the verdicts."""
        ctl = spark.read.parquet(self._path("control"))
        ver = self.verdicts(spark).select(F.col("batch_id").alias("check_batch"), "dataset_drift")
        # the latest check at or before each batch: a running max over one row per batch
        w = Window.orderBy("batch_id").rowsBetween(Window.unboundedPreceding, 0)
        ctl = ctl.withColumn("check_batch", F.max(F.when(F.col("checked"), F.col("batch_id"))).over(w))
        j = ctl.join(ver, "check_batch", "left")
        state = (F.when(F.col("dataset_drift").isNull(), "warming up")
                 .when(F.col("dataset_drift"), "drift detected").otherwise("healthy"))
        return j.select("batch_id", "rows_seen", "rows_since", "checked", state.alias("state"))
