"""Landed files taken over exactly once, and lines that cannot be read set apart."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from basketlens.schemas import DQ_COLUMNS
from basketlens.session import scratch_path
from basketlens.sources.writers import HISTORY_PARTITIONS

MALFORMED = "Malformed row"
_RECORD, _FILE, _BAD = "__record", "__file", "__bad"


def _fields(schema: StructType | str) -> StructType:
    return StructType.fromDDL(schema) if isinstance(schema, str) else schema


def split_malformed(
    spark: SparkSession, path: str, kind: str, schema: StructType | str, *, name: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """The rows of CSV or JSON files that fit the schema, and those that do not (record, file).

    A CSV line with too many or too few values and a JSON line that is broken off do not fit, nor does a
    value of another type; values are never filled up or cut off instead. The files are read once: both results are partitions
    of one table in the shared folder. Lines are records, so large files are read by many tasks.
    """
    if kind not in ("csv", "json"):
        raise ValueError(f"unknown text format {kind!r}")
    schema = _fields(schema)
    read_as = StructType([*schema.fields, StructField(_RECORD, StringType())])
    reader = spark.read.schema(read_as).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", _RECORD)
    reader = reader.option("recursiveFileLookup", True)
    if name is not None:
        reader = reader.option("pathGlobFilter", name)
    if kind == "csv":
        reader = reader.option("header", True).option("escape", '"').option("enforceSchema", True)
    scanned = reader.format(kind).load(path).withColumns(
        {_FILE: F.col("_metadata.file_path"), _BAD: F.col(_RECORD).isNotNull()}
    )
    both = scratch_path(spark, "landed")
    scanned.write.partitionBy(_BAD).parquet(both)
    rows = spark.read.schema(scanned.schema).parquet(both)
    good = rows.where(~F.col(_BAD)).select(*schema.names)
    return good, rows.where(_BAD).select(F.col(_RECORD).alias("record"), F.col(_FILE).alias("file"))


def malformed_report(bad: DataFrame, table: str, *, data_date: str, run_ts: str) -> DataFrame:
    """The records set apart as rows of the data-quality report, named by file and hash."""
    columns = {
        "dataDate": F.lit(data_date),
        "errorType": F.lit(MALFORMED),
        "checkTable": F.lit(table),
        "checkField": F.lit("*"),
        "checkFieldValue": F.col("record"),
        "primaryKey": F.lit("file,hash"),
        "primaryKeyValue": F.concat_ws(",", F.element_at(F.split("file", "/"), -1), F.md5("record")),
        "errorMessage": F.lit(f"A record for the Table {table} does not fit its columns"),
        "runDate": F.lit(run_ts).cast("timestamp"),
    }
    return bad.select(*[columns[c].alias(c) for c in DQ_COLUMNS])


def new_files(
    spark: SparkSession,
    path: str,
    kind: str,
    schema: StructType | str,
    *,
    name: str | None = None,
    max_files: int | None = None,
) -> DataFrame:
    """A stream of the files below ``path``; ``max_files`` bounds how many go into one step."""
    reader = spark.readStream.format(kind).schema(_fields(schema)).option("recursiveFileLookup", True)
    if kind == "csv":
        reader = reader.option("header", True).option("escape", '"')
    if name is not None:
        reader = reader.option("pathGlobFilter", name)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path)


def land_once(
    stream: DataFrame, path: str, checkpoint: str, partition_by: tuple[str, ...] = HISTORY_PARTITIONS
) -> int:
    """Append what ``stream`` finds of new files to the table at ``path`` and stop; gives the number of rows.

    ``checkpoint``, in the shared folder, remembers the files taken over, and the table's own log which of its
    files count. So a file lands once however often this is run, and files of a run that was stopped are ignored
    and written anew by the next one. Only streams may write to the table; ``spark.read.parquet`` follows its log.
    """
    writer = stream.writeStream.format("parquet").outputMode("append").trigger(availableNow=True)
    writer = writer.partitionBy(*partition_by).option("checkpointLocation", checkpoint)
    running = writer.start(path)
    try:
        running.awaitTermination()
    finally:
        running.stop()
    return sum(progress["numInputRows"] for progress in running.recentProgress)
