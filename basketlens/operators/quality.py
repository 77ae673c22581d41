"""Data-quality checks that report offending rows in one common schema."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketlens.functions.columns import null_safe_match
from basketlens.operators.ordering import keep_first, keep_latest
from basketlens.schemas import DQ_COLUMNS

# Error types and the wording of the messages.
NULL_VALUE = "Null value"
DUPLICATED = "Duplicated value"
MAPPING = "Field mapping"


def any_null(fields: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(f).isNull() for f in fields])


def no_null(fields: Sequence[str]) -> Column:
    return ~any_null(fields)


def _report(
    rows: DataFrame,
    error: str,
    table: str,
    fields: Sequence[str],
    values: Sequence[str],
    primary_key: Sequence[str],
    data_date: str,
    run_ts: str,
) -> DataFrame:
    named, value = ",".join(fields), F.concat_ws(",", *values)
    subject = f"The Column(s) {named} of the Table {table}"
    message = {
        NULL_VALUE: F.lit(f"{subject} is null"),
        DUPLICATED: F.concat(F.lit(f"{subject} have duplicated value: ["), value, F.lit("]")),
        MAPPING: F.lit(f"{subject} is invalid"),
    }[error]
    columns = {
        "dataDate": F.lit(data_date),
        "errorType": F.lit(error),
        "checkTable": F.lit(table),
        "checkField": F.lit(named),
        "checkFieldValue": value,
        "primaryKey": F.lit(",".join(primary_key)),
        "primaryKeyValue": F.concat_ws(",", *primary_key),
        "errorMessage": message,
        "runDate": F.lit(run_ts).cast("timestamp"),
    }
    return rows.select(*[columns[name].alias(name) for name in DQ_COLUMNS])


def check_null(
    df: DataFrame,
    table: str,
    fields: Sequence[str],
    primary_key: Sequence[str],
    *,
    data_date: str,
    run_ts: str,
    where: Column | str | None = None,
) -> DataFrame:
    """One report row per record in which any of ``fields`` is NULL."""
    rows = df if where is None else df.where(where)
    return _report(
        rows.where(any_null(fields)), NULL_VALUE, table, fields, fields, primary_key,
        data_date, run_ts,
    )


def check_duplicate(
    df: DataFrame,
    table: str,
    fields: Sequence[str],
    primary_key: Sequence[str],
    *,
    kind: str,
    time_column: str,
    tie_break: Sequence[str],
    data_date: str,
    run_ts: str,
    where: Column | str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Report every member of each duplicate group; also return the cleaned rows.

    ``kind`` "Dimension" keeps one row per primary key, "Fact" the latest row per
    ``fields``. Groups are formed on the columns themselves (NULLs equal), and their size
    is counted over the whole group. Sizes are pre-aggregated and matched back with a semi
    join, so no group has to fit into one task.
    """
    rows = df if where is None else df.where(where)
    repeated = rows.groupBy(*fields).count().where("count > 1").drop("count")
    right, condition = null_safe_match(repeated, fields)
    members = rows.join(right, condition, "left_semi")
    report = _report(
        members, DUPLICATED, table, fields, fields, primary_key, data_date, run_ts
    )
    if kind == "Dimension":
        clean = keep_first(rows, primary_key, [F.col(c).asc_nulls_last() for c in tie_break])
    else:
        clean = keep_latest(rows, fields, time_column, tie_break)
    return report, clean


def mapping_failed(keys: Sequence[str]) -> Column:
    """For columns ``X_Key`` of a joined frame: key missing although ``X_FK`` is given."""
    stems = [k.removesuffix("_Key") for k in keys]
    return reduce(
        lambda a, b: a | b,
        [F.col(f"{s}_Key").isNull() & F.col(f"{s}_FK").isNotNull() for s in stems],
    )


def check_mapping(
    df: DataFrame,
    table: str,
    keys: Sequence[str],
    primary_key: Sequence[str],
    *,
    data_date: str,
    run_ts: str,
    where: Column | str | None = None,
) -> DataFrame:
    """Report rows of a fact already joined to its dimensions with an unmatched key."""
    rows = df if where is None else df.where(where)
    foreign = [k.removesuffix("_Key") + "_FK" for k in keys]
    return _report(
        rows.where(mapping_failed(keys)), MAPPING, table, keys, foreign, primary_key,
        data_date, run_ts,
    )


def with_mapped_key(fact: DataFrame, dimension: DataFrame, stem: str, key: str) -> DataFrame:
    """Add ``<stem>_Key``: the foreign key where the dimension knows it, else NULL.

    Only the distinct foreign keys meet the dimension; the (normally few) unknown ones are
    matched back. The hot foreign keys of the fact are therefore reduced to one row each
    before any shuffle, and the fact side moves only if there are too many unknown keys
    for Spark to broadcast.
    """
    foreign = f"{stem}_FK"
    known = dimension.select(F.col(key).alias(foreign))
    unknown = (
        fact.where(F.col(foreign).isNotNull())
        .select(foreign)
        .distinct()
        .join(known, foreign, "left_anti")
        .withColumn("__unknown", F.lit(True))
    )
    return (
        fact.join(unknown, foreign, "left")
        .withColumn(f"{stem}_Key", F.when(F.col("__unknown").isNull(), F.col(foreign)))
        .drop("__unknown")
    )
