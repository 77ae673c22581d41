"""Calendar and product dimensions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from basketlens.functions.calendar import half_year, sunday_week
from basketlens.functions.columns import as_of_text, surrogate_key
from basketlens.operators.ordering import keep_first, latest_batch
from basketlens.operators.quality import no_null

# The default calendar, both ends included.
FIRST_DAY, LAST_DAY = "2019-01-01", "2049-12-31"


def _calendar(days: DataFrame, half_year_last_month: int) -> DataFrame:
    day: Column = F.col("day")
    midnight = day.cast("timestamp")
    return days.select(
        midnight.alias("Date_Key"),
        F.year(day).alias("Year"),
        half_year(day, half_year_last_month).alias("HalfYear"),
        F.quarter(day).alias("Quarter"),
        F.month(day).alias("Month"),
        F.date_format(day, "MMM").alias("MonthName"),
        (F.year(day) * 100 + F.month(day)).alias("YearMonth"),
        sunday_week(day).alias("Week"),
        F.dayofmonth(day).alias("Day"),
        (F.dayofweek(day) - 1).alias("Weekday"),
        midnight.alias("Date"),
    )


def dim_date(
    spark: SparkSession,
    first: str = FIRST_DAY,
    last: str = LAST_DAY,
    *,
    half_year_last_month: int = 5,
) -> DataFrame:
    """One row per day. Weekday counts from Sunday = 0, Week is the Sunday-based week."""
    days = spark.range(1).select(
        F.explode(F.sequence(F.lit(first).cast("date"), F.lit(last).cast("date"))).alias("day")
    )
    return _calendar(days, half_year_last_month)


def dim_date_spanning(
    df: DataFrame, when: str, *, half_year_last_month: int = 5
) -> DataFrame:
    """The calendar of all whole years in which ``df`` has a ``when``."""
    years = df.agg(F.min(when).alias("first"), F.max(when).alias("last"))
    first = F.trunc(F.col("first").cast("date"), "year")
    last = F.date_sub(F.add_months(F.trunc(F.col("last").cast("date"), "year"), 12), 1)
    days = years.select(F.explode(F.sequence(first, last)).alias("day"))
    return _calendar(days, half_year_last_month)


def dim_product(history: DataFrame, etl_ts: str) -> DataFrame:
    """One row per product of the latest batch, its category code split into four levels.

    Where a product occurs with several attribute sets the first in ascending order is
    kept, so that the choice does not depend on the order of the input.
    """
    attributes = ["CATEGORY_ID", "CATEGORY_CODE", "BRAND"]
    products = latest_batch(history.select("PRODUCT_ID", *attributes, "BATCHNUMBER")).where(
        no_null(["PRODUCT_ID"])
    )
    chosen = keep_first(
        products, ["PRODUCT_ID"], [F.col(c).asc_nulls_last() for c in attributes]
    )
    levels = F.split("CATEGORY_CODE", r"\.")
    names = ["CATEGORY", "SUBCATEGORY1", "SUBCATEGORY2", "SUBCATEGORY3"]
    return chosen.select(
        surrogate_key("PRODUCT_ID").alias("PRODUCT_ID_KEY"),
        "PRODUCT_ID",
        "CATEGORY_ID",
        *[F.get(levels, F.lit(i)).alias(name) for i, name in enumerate(names)],
        "BRAND",
        as_of_text(etl_ts).alias("ETLUPDATEDDATETIME"),
    ).fillna("N/A", subset=[*names, "BRAND"])
