"""Landing files to history tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketlens.functions.columns import upper_columns, with_partition_columns


def hist_behaviour_log(landed: DataFrame, batch: int) -> DataFrame:
    """Stamp the batch, type EVENT_TIME and derive the partition columns from it."""
    events = upper_columns(landed).withColumns(
        {
            "BATCHNUMBER": F.lit(batch).cast("int"),
            "EVENT_TIME": F.col("EVENT_TIME").try_cast("timestamp"),
        }
    )
    return with_partition_columns(events, "EVENT_TIME")


def hist_sales_target(landed: DataFrame, batch: int, run_date: str) -> DataFrame:
    """Stamp the batch, type the numbers; partitions come from the run date (yyyy-MM-dd)."""
    targets = upper_columns(landed).withColumns(
        {
            "BATCHNUMBER": F.lit(batch).cast("int"),
            "YEARMONTH": F.col("YEARMONTH").try_cast("int"),
            "TARGET": F.col("TARGET").try_cast("double"),
        }
    )
    return with_partition_columns(targets, F.lit(run_date).cast("date"))
