"""Source scans with an audit row per source."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

AUDIT_DDL = (
    "batchID STRING, date STRING, startTime STRING, notebook STRING, count STRING, "
    "file STRING, exist STRING"
)


def read_csv(
    spark: SparkSession,
    path: str,
    schema: StructType | str | None = None,
    *,
    multiline: bool = True,
    name: str | None = None,
) -> DataFrame:
    """CSV with a header, ``"`` as quote and escape; all columns text unless a schema is given.

    ``multiline`` allows line breaks inside quoted values but makes every file one task;
    turn it off for large files without such values. ``name`` selects the equally named
    files anywhere below ``path``.
    """
    reader = spark.read.option("header", True).option("escape", '"').option("multiLine", multiline)
    if name is not None:
        reader = reader.option("recursiveFileLookup", True).option("pathGlobFilter", name)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.csv(path)


def read_json(
    spark: SparkSession, path: str, schema: StructType | str | None = None
) -> DataFrame:
    """JSON lines anywhere below ``path``; a given schema saves the inference pass."""
    reader = spark.read.option("recursiveFileLookup", True)
    return (reader if schema is None else reader.schema(schema)).json(path)


def read_parquet(
    spark: SparkSession, path: str, schema: StructType | str | None = None
) -> DataFrame:
    return (spark.read if schema is None else spark.read.schema(schema)).parquet(path)


READERS = {"csv": read_csv, "json": read_json, "parquet": read_parquet}


@dataclass
class SourceRead:
    """A scanned source. ``rows`` is None when the path does not exist or holds no file.

    The row count is observed while ``rows`` is being used, so it costs no pass of its
    own; ``counted`` is available after the first action on ``rows``.
    """

    rows: DataFrame | None
    observation: Observation | None

    @property
    def counted(self) -> int | None:
        return None if self.observation is None else self.observation.get["rows"]


def read_source(
    spark: SparkSession, path: str, kind: str, schema: StructType | str | None = None, **options
) -> SourceRead:
    """Scan a source by format name, counting its rows in the same pass.

    ``options`` go to the reader of that format. Without a schema an empty folder shows when Spark
    looks for one; with a schema the number of files says it.
    """
    if kind not in READERS:
        raise ValueError(f"unknown source format {kind!r}, expected one of {sorted(READERS)}")
    try:
        df = READERS[kind](spark, path, schema, **options)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return SourceRead(None, None)
        raise
    if schema is not None and not df.inputFiles():
        return SourceRead(None, None)
    seen = Observation()
    return SourceRead(df.observe(seen, F.count(F.lit(1)).alias("rows")), seen)


def audit_row(
    spark: SparkSession,
    *,
    batch: int,
    date: str,
    start_time: str,
    item: str,
    file: str,
    count: int | None,
) -> DataFrame:
    """The audit row of a source: its row count, or N/A and exist = N if it is missing."""
    found = count is not None
    row = (
        str(batch), date, start_time, item, str(count) if found else "N/A", file,
        "Y" if found else "N",
    )
    return spark.createDataFrame([row], AUDIT_DDL)


def audit_frame(
    df: DataFrame, *, batch: int, date: str, start_time: str, item: str, file: str
) -> DataFrame:
    """The audit row as a lazy aggregate, for callers that have no action to observe."""
    constants = {
        "batchID": str(batch), "date": date, "startTime": start_time, "notebook": item,
        "file": file, "exist": "Y",
    }
    counted = df.agg(F.count(F.lit(1)).cast("string").alias("count"))
    counted = counted.withColumns({name: F.lit(value) for name, value in constants.items()})
    return counted.select(*[column.split()[0] for column in AUDIT_DDL.split(", ")])
