"""Table and file sinks.

Partitioned writes rebalance the rows by the partition columns: adaptive execution merges
small partitions into one task and splits a partition that holds most of the rows, so
files come out evenly sized whatever the distribution.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

HISTORY_PARTITIONS = ("PARTITIONYEAR", "PARTITIONMONTH", "PARTITIONDAY", "BATCHNUMBER")
FACT_PARTITIONS = HISTORY_PARTITIONS[:3]


def laid_out(df: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    return df.hint("rebalance", *partition_by) if partition_by else df


def append_partitioned(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = HISTORY_PARTITIONS,
) -> None:
    laid_out(df, partition_by).write.mode("append").partitionBy(*partition_by).parquet(path)


def overwrite_path(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Replace everything at ``path``. ``df`` must not read from it (see ``rewrite_table``)."""
    writer = laid_out(df, partition_by).write.mode("overwrite")
    writer.option("partitionOverwriteMode", "static").partitionBy(*partition_by).parquet(path)


def put_partitions(df: DataFrame, path: str, partition_by: Sequence[str]) -> None:
    """Replace the partitions that occur in ``df``, which must not read from ``path``."""
    writer = laid_out(df, partition_by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*partition_by).parquet(path)


def overwrite_table(
    df: DataFrame, name: str, path: str | None = None, partition_by: Sequence[str] = ()
) -> None:
    """Replace a catalog table, external if a path is given."""
    writer = laid_out(df, partition_by).write.mode("overwrite").format("parquet")
    if path is not None:
        writer = writer.option("path", path)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.saveAsTable(name)


def create_or_append_table(df: DataFrame, name: str) -> None:
    """Append to a managed table, creating it on first use."""
    exists = df.sparkSession.catalog.tableExists(name)
    df.write.mode("append" if exists else "overwrite").format("parquet").saveAsTable(name)


def ensure_path(
    spark: SparkSession, schema: StructType, path: str, partition_by: Sequence[str] = ()
) -> None:
    """Create an empty table at ``path`` unless there is one."""
    empty = spark.createDataFrame([], schema)
    empty.write.mode("ignore").partitionBy(*partition_by).parquet(path)


def append_quarantine(report: DataFrame, path: str) -> None:
    """Add the rows a check reported. Reports of other checks are kept."""
    report.write.mode("append").parquet(path)


def quarantine_table(spark: SparkSession, name: str, path: str) -> None:
    """Register the quarantine folder as a table, replacing a stale registration."""
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(f"CREATE TABLE {name} USING parquet LOCATION '{path}'")


def write_json_log(report: DataFrame, path: str) -> bool:
    """Write the bad rows as JSON if there are any; tells whether there were."""
    if report.isEmpty():
        return False
    report.write.mode("overwrite").json(path)
    return True


def write_csv(df: DataFrame, path: str, *, single_file: bool = False) -> None:
    """CSV with a header. ``single_file`` is for summaries of a few rows only."""
    (df.coalesce(1) if single_file else df).write.mode("overwrite").option("header", True).csv(path)
