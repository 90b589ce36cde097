"""Spark session and run-environment helpers.

The library never creates a session inside an operator: every report takes
DataFrames and returns a DataFrame. These helpers are for entry points
(bench, tests, the refresh job).
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every entry point wants. AQE re-plans joins from runtime sizes
# (a small aggregated side becomes a broadcast, skewed partitions are split)
# and coalesces the post-aggregation shuffles, which are tiny for reports.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(
    master: str | None = None,
    app_name: str = "cxpulse",
    shuffle_partitions: int | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """Return (or create) a session with the library's defaults.

    On a cluster leave ``master`` unset and size ``shuffle_partitions`` to
    the input (roughly input bytes / 128 MB); locally it defaults to the core
    count.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = dict(DEFAULT_CONF)
    if shuffle_partitions is None and master and master.startswith("local"):
        cores = master[len("local["):-1] if "[" in master else "1"
        shuffle_partitions = os.cpu_count() if cores == "*" else int(cores)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    return spark


def checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """The shared folder the cluster names for checkpoints.

    Reads ``spark.checkpoint.dir`` from the session. Only when it is unset
    (local tests) is ``fallback`` installed; on a cluster it must be set to a
    shared file system, never a machine-local path.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    current = spark.sparkContext.getCheckpointDir()
    if configured:
        if not current:
            spark.sparkContext.setCheckpointDir(configured)
        return configured
    if current:
        return current
    if fallback is None:
        raise RuntimeError(
            "spark.checkpoint.dir is not set; set it to a shared folder "
            "(or pass a fallback in tests)"
        )
    spark.sparkContext.setCheckpointDir(fallback)
    return fallback


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``. Only a local master may go without
    it (it then gets a temporary folder)."""
    local = spark.sparkContext.master.startswith("local")
    known = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    return checkpoint_dir(spark, fallback=None if known or not local else tempfile.mkdtemp(prefix="cxpulse-"))


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read again: cuts the
    lineage and survives lost executors."""
    path = os.path.join(shared_folder(df.sparkSession), f"cxpulse-{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
