"""Counts per product and day kept up by batch; the weekly tables follow from them without the events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from basketlens.operators.merge import touched_partitions
from basketlens.plans import weekly
from basketlens.session import passing
from basketlens.sources.writers import ensure_path, put_partitions

_DDL = "PRODUCT_ID STRING, SALES_OCCURRENCE LONG, VIEW_COUNT LONG, CART_COUNT LONG, PRICED LONG, PRICES DOUBLE, DAY STRING"
_KEPT = "SALES_OCCURRENCE + VIEW_COUNT + CART_COUNT > 0"


def counted_days(events: DataFrame) -> DataFrame:
    """Purchases, views, carts and the sum of known purchase prices per product and day."""
    bought = F.col("EVENT_TYPE") == "purchase"
    counts = [F.count_if(F.col("EVENT_TYPE") == kind).alias(name) for kind, (name, _) in weekly.PERSPECTIVES.items()]
    return (
        events.where(F.col("EVENT_TYPE").isin(list(weekly.PERSPECTIVES)))
        .groupBy("PRODUCT_ID", F.col("EVENT_DATE").cast("string").alias("DAY"))
        .agg(
            *counts,
            F.count(F.when(bought, F.col("PRICE"))).alias("PRICED"),
            F.sum(F.when(bought, F.col("PRICE"))).alias("PRICES"),
        )
    )


class DayCounts:
    """Day counts below ``path``, a partition per date. An update replaces the partitions of its dates, so to repeat one
    that was stopped, or to take over rows that were delivered late, is the same update once more."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        ensure_path(spark, StructType.fromDDL(_DDL), path, ["DAY"])

    def update(self, events: DataFrame, dates: DataFrame) -> None:
        """Take over the fact's rows of some dates (a column EVENT_DATE); ``events`` has all rows of these dates,
        rows of other dates are ignored."""
        dates = dates.select(F.col("EVENT_DATE").cast("string").alias("EVENT_DATE")).distinct()
        ours = events.withColumn("EVENT_DATE", F.col("EVENT_DATE").cast("string"))
        with passing(dates, "dates") as touched:
            fresh = counted_days(touched_partitions(ours, touched, ["EVENT_DATE"]))
            zero = {c: F.lit(0).cast("long") for c in ("SALES_OCCURRENCE", "VIEW_COUNT", "CART_COUNT", "PRICED")}
            # a date without events any more is replaced as well
            empty = touched.select(F.col("EVENT_DATE").alias("DAY")).withColumns(
                {"PRODUCT_ID": F.lit(None).cast("string"), **zero, "PRICES": F.lit(None).cast("double")}
            )
            put_partitions(fresh.unionByName(empty), self.path, ["DAY"])

    def days(self) -> DataFrame:
        """One row per product and day with an event, with the columns of its week."""
        rows = self.spark.read.schema(_DDL).parquet(self.path).where(_KEPT)
        return weekly.with_weeks(rows.withColumnRenamed("DAY", "EVENT_DATE"))

    def weekly_sales(self, by_cycle: bool = False) -> DataFrame:
        """As ``weekly.weekly_sales`` over all events."""
        week = weekly.WEEK if by_cycle else ["WEEK_NUMBER"]
        sold = self.days().where("SALES_OCCURRENCE > 0 and EVENT_DATE is not null")
        price = (F.col("PRICES") / F.nullif("PRICED", F.lit(0))).alias("AVG_PRICE")
        daily = sold.select("PRODUCT_ID", "EVENT_DATE", F.col("SALES_OCCURRENCE").alias("SALES"), price, *week)
        return weekly.sales_of_days(daily, week)

    def weekly_demand(self, by_cycle: bool = False) -> DataFrame:
        return weekly.with_previous_week(self.weekly_sales(by_cycle)).na.drop()

    def weekly_counts(self) -> DataFrame:
        """As ``weekly.weekly_counts`` over all events."""
        counts = [F.sum(name).alias(name) for name, _ in weekly.PERSPECTIVES.values()]
        price = F.sum("PRICES") / F.nullif(F.sum("PRICED"), F.lit(0))
        return self.days().groupBy(*weekly.CELL).agg(price.alias("MEAN_PRICE"), *counts)

    def feature_matrix(self) -> DataFrame:
        features = weekly.log_counts(weekly.features_of_weeks(self.weekly_counts()))
        return features.select(*weekly.CELL, "SALES_OCCURRENCE", *weekly.FEATURES)
