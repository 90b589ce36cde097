"""Helpers shared by the operators: reading tables, shared intermediate tables."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

from cxpulse.session import checkpoint_dir


_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def importable(spark: SparkSession) -> None:
    """Let Python workers look for the package where the driver found it, also
    when the driver was started from another folder."""
    env = spark.sparkContext.environment
    if _ROOT not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (env.get("PYTHONPATH"), _ROOT) if x)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    importable(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``. Only a local master may go
    without it (tests): it then gets a temporary one."""
    if not spark.conf.get("spark.checkpoint.dir", None) and not spark.sparkContext.getCheckpointDir():
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        return checkpoint_dir(spark, fallback=tempfile.mkdtemp(prefix="llm-shared-"))
    return checkpoint_dir(spark)


#: where ``materialise`` writes within ``step_tables``
_step: ContextVar[str | None] = ContextVar("step", default=None)


def own_folder(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing else uses."""
    return f"{shared_dir(spark).rstrip('/')}/llm-{name}-{uuid.uuid4().hex}"


def delete(spark: SparkSession, path: str) -> None:
    """Delete a folder of the shared file system, if it is there."""
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    found.getFileSystem(spark._jsc.hadoopConfiguration()).delete(found, True)


@contextmanager
def step_tables(spark: SparkSession) -> Iterator[None]:
    """Tables that ``materialise`` writes within are deleted at the end: for steps
    whose result is written elsewhere before that."""
    folder = own_folder(spark, "step")
    token = _step.set(folder)
    try:
        yield
    finally:
        _step.reset(token)
        delete(spark, folder)


def materialise(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder (or ``path``) and read it again:
    cuts the lineage, survives lost executors, and gives the next plan true sizes."""
    spark = df.sparkSession
    importable(spark)
    if path is None:
        path = f"{_step.get()}/{name}-{uuid.uuid4().hex}" if _step.get() else own_folder(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
