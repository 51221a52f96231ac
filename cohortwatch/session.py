"""Spark session defaults and the shared working folder.

The library never writes to a machine-local temporary folder on a cluster:
intermediate tables go under ``spark.checkpoint.dir`` (the shared folder the
cluster names). Only when that setting is unset -- local tests -- does the
library pick a folder of its own.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings that matter at scale; all are plain Spark configuration.
DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # broadcast only when the planner has a size estimate below this bound
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    # checkpoint files of dropped DataFrames are removed by the context cleaner
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}
# Only applies when this process starts the JVM (local runs, tests, bench).
LOCAL_DRIVER_MEMORY = "16g"


def get_spark(master: str | None = None, app: str = "cohortwatch",
              shuffle_partitions: int | None = None,
              extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
        if master.startswith("local"):
            builder = builder.config("spark.driver.memory", LOCAL_DRIVER_MEMORY)
    for k, v in DEFAULT_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


# shared folders this process chose itself (only when the cluster names none), by application id
_OWN_DIRS: dict[str, str] = {}


def _conf_checkpoint_dir(spark: SparkSession) -> str | None:
    d = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not d:
        try:
            d = spark.conf.get("spark.checkpoint.dir", None)
        except Exception:  # noqa: BLE001 - conf lookups differ between modes
            d = None
    return d or None


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared folder; set the checkpoint folder once, only when the cluster names none.

    Spark adds a per-application sub-folder under the folder given to
    ``setCheckpointDir``, so it is called at most once per application.
    """
    sc = spark.sparkContext
    conf_dir = _conf_checkpoint_dir(spark)
    current = sc._jsc.sc().getCheckpointDir()
    app = sc.applicationId
    if current.isDefined():
        if conf_dir:
            return conf_dir
        if app in _OWN_DIRS:
            return _OWN_DIRS[app]
        return os.path.dirname(str(current.get()).rstrip("/"))
    base = conf_dir or _OWN_DIRS.get(app)
    if base is None:
        # executors on other machines cannot see a folder of this one
        if sc.master != "local" and not sc.master.startswith("local["):
            raise RuntimeError("spark.checkpoint.dir is not set: name a folder that all executors share")
        base = tempfile.mkdtemp(prefix="cohortwatch-ckpt-")
        _OWN_DIRS[app] = base
    sc.setCheckpointDir(base)
    return base


def shared_path(spark: SparkSession, *parts: str, unique: bool = True) -> str:
    """A fresh path under the shared checkpoint folder for written tables."""
    base = ensure_checkpoint_dir(spark)
    # checkpoint dirs get a per-application sub-folder from Spark; stay beside it
    leaf = list(parts) + ([uuid.uuid4().hex[:12]] if unique else [])
    return os.path.join(base, "cohortwatch", *leaf)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint (survives executor loss); never localCheckpoint."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
