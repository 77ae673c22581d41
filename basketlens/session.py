"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the run-time settings every plan here relies on (UTC first of all)."""
    for key, value in RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder name below the shared folder in ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder of this machine.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        base = tempfile.gettempdir()
    return f"{base.rstrip('/')}/basketlens-{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared scratch folder and read back.

    For a result that several later steps scan: it is computed once, the plans after it
    start from files, and a lost executor costs only the files' readers a retry.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def make_folder(spark: SparkSession, path: str) -> None:
    """Create an empty folder wherever Spark can reach it."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(folder)


def path_exists(spark: SparkSession, path: str) -> bool:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder)


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a folder wherever Spark can reach it; a missing one is fine."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


@contextmanager
def passing(df: DataFrame, name: str) -> Iterator[DataFrame]:
    """Like ``stored`` for as long as the block runs; the copy is removed if it ends well."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    yield df.sparkSession.read.schema(df.schema).parquet(path)
    remove_path(df.sparkSession, path)
