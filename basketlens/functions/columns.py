"""Small column and projection helpers shared by the plans."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType


def upper_columns(df: DataFrame) -> DataFrame:
    """Upper-case every column name."""
    return df.toDF(*[name.upper() for name in df.columns])


def trim_strings(df: DataFrame) -> DataFrame:
    """Trim string columns; other types pass unchanged (no cast to text)."""
    return df.select(
        *[
            F.trim(f.name).alias(f.name) if isinstance(f.dataType, StringType) else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def with_partition_columns(df: DataFrame, when: Column | str) -> DataFrame:
    """Add PARTITIONYEAR / PARTITIONMONTH / PARTITIONDAY taken from a date or timestamp."""
    return df.withColumns(
        {
            "PARTITIONYEAR": F.year(when),
            "PARTITIONMONTH": F.month(when),
            "PARTITIONDAY": F.dayofmonth(when),
        }
    )


def surrogate_key(value: Column | str) -> Column:
    """64-bit hash key of a natural key. A NULL natural key hashes to the seed, 42."""
    return F.xxhash64(value)


def piped(*parts: str) -> Column:
    """``a|b|c`` as text; NULL as soon as one part is NULL."""
    columns: list[Column] = []
    for part in parts:
        columns += [F.lit("|"), F.col(part).cast("string")]
    return F.concat(*columns[1:])


def null_safe_match(df: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, Column]:
    """``df`` with its keys renamed, and a join condition matching them NULL-safely.

    The renaming keeps the condition unambiguous when ``df`` descends from the other side.
    """
    names = {key: f"__{key}" for key in keys}
    condition = F.lit(True)
    for key, renamed in names.items():
        condition = condition & F.col(key).eqNullSafe(F.col(renamed))
    return df.withColumnsRenamed(names), condition


def ratio(numerator: Column | str, denominator: Column | str) -> Column:
    """Quotient, NULL when the denominator is zero or NULL."""
    return F.try_divide(F.col(numerator) if isinstance(numerator, str) else numerator,
                        F.col(denominator) if isinstance(denominator, str) else denominator)


# Text-to-timestamp conversions; text that does not fit gives NULL.
def parse_day_first(value: Column | str) -> Column:
    """``31/12/2019 23:59:59``"""
    return F.try_to_timestamp(value, F.lit("dd/MM/yyyy HH:mm:ss"))


def parse_year_first_micros(value: Column | str) -> Column:
    """``2019-12-31 23:59:59.123456``"""
    return F.try_to_timestamp(value, F.lit("yyyy-MM-dd HH:mm:ss.SSSSSS"))


def as_of_text(run_ts: str) -> Column:
    """The run time argument as a timestamp column."""
    return F.lit(run_ts).cast("timestamp")
