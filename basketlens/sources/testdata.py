"""The test tables presented as behaviour events, sales, targets and run logs.

The SQL twins of these views are in ``basketlens.oracle``; both follow FIXTURES.md.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    ts = F.col("ts").cast("timestamp")
    return table(spark, sf_dir, "events").select(
        ts.alias("EVENT_TIME"),
        F.when(F.col("event_type") == "click", "cart")
        .otherwise(F.col("event_type"))
        .alias("EVENT_TYPE"),
        F.get_json_object("props", "$.k").cast("bigint").alias("k"),
        F.when(F.col("event_id") % 53 == 0, 0.0).otherwise(F.col("value")).alias("PRICE"),
        F.col("user_id").cast("string").alias("USER_ID"),
        F.concat_ws("-", "user_id", F.date_format(ts, "yyyyMMdd")).alias("USER_SESSION"),
        F.when(F.dayofmonth(ts) <= 15, 1).otherwise(2).alias("BATCHNUMBER"),
        "event_id",
    )


def _product_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("p_partkey")
    full = F.concat_ws(
        ".",
        F.lower("p_type"),
        F.replace("p_name", F.lit(" "), F.lit(".")),
        F.when(k % 5 == 0, F.col("p_size").cast("string")),
    )
    return table(spark, sf_dir, "part").select(
        k.alias("k"),
        F.col("p_size").cast("string").alias("CATEGORY_ID"),
        F.when(k % 7 == 0, None)
        .when(k % 3 == 0, F.lower("p_type"))
        .otherwise(full)
        .alias("CATEGORY_CODE"),
        F.when(k % 11 == 0, None).otherwise(F.col("p_brand")).alias("BRAND"),
    )


def behaviour_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The behaviour log without the product attributes (no join)."""
    events = _events(spark, sf_dir)
    return events.withColumn("PRODUCT_ID", F.col("k").cast("string")).drop("k")


def behaviour_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The behaviour log with category and brand of each product.

    Products without an event are left out before the join, so that what Spark may broadcast
    grows with the products in use and not with the catalogue.
    """
    events = _events(spark, sf_dir)
    products = _product_columns(spark, sf_dir).join(events.select("k").distinct(), "k", "left_semi")
    joined = events.join(products, "k", "left")
    return joined.withColumn("PRODUCT_ID", F.col("k").cast("string")).select(
        "EVENT_TIME", "EVENT_TYPE", "PRODUCT_ID", "CATEGORY_ID", "CATEGORY_CODE", "BRAND",
        "PRICE", "USER_ID", "USER_SESSION", "BATCHNUMBER", "event_id",
    )


def with_faults(events: DataFrame) -> DataFrame:
    """Exact copies, missing users and missing products, as a dirty landing would have."""
    copies = F.when(F.col("event_id") % 41 == 0, F.array(F.lit(0), F.lit(1))).otherwise(
        F.array(F.lit(0))
    )
    return events.withColumn("copy", F.explode(copies)).withColumns(
        {
            "USER_ID": F.when(F.col("event_id") % 97 != 0, F.col("USER_ID")),
            "PRODUCT_ID": F.when(F.col("event_id") % 101 != 0, F.col("PRODUCT_ID")),
        }
    )


def events_as_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The columns of the behaviour fact that the analyses read, unpaid purchases dropped."""
    events = behaviour_events(spark, sf_dir)
    return events.where((F.col("EVENT_TYPE") != "purchase") | (F.col("PRICE") > 0)).select(
        F.col("EVENT_TIME").alias("EVENT_DATETIME"),
        F.date_format("EVENT_TIME", "yyyy-MM-dd").alias("EVENT_DATE"),
        "EVENT_TYPE", "PRODUCT_ID", "PRICE", "USER_ID", "USER_SESSION",
    )


def lineitem_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seven years of purchases of ten products."""
    return table(spark, sf_dir, "lineitem").select(
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("EVENT_DATE"),
        F.lit("purchase").alias("EVENT_TYPE"),
        (F.col("l_partkey") % 10).cast("string").alias("PRODUCT_ID"),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("PRICE"),
    )


def sales_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monthly order totals per country as targets."""
    country = (
        table(spark, sf_dir, "customer")
        .join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .select(F.col("c_custkey").alias("o_custkey"), F.col("n_name").alias("COUNTRY"))
    )
    month = F.year("o_orderdate") * 100 + F.month("o_orderdate")
    return (
        table(spark, sf_dir, "orders")
        .select("o_custkey", "o_totalprice", month.alias("YEARMONTH"))
        .join(country, "o_custkey")
        .groupBy("COUNTRY", "YEARMONTH")
        .agg(F.round(F.sum("o_totalprice"), 2).alias("TARGET"))
        .withColumn("BATCHNUMBER", F.when(F.col("YEARMONTH") < 200000, 1).otherwise(2))
    )


# Items a ledger row can belong to, by customer key; "Start" opens a batch.
ITEMS = (
    "Start", "hist_behaviour_log", "hist_sales_target", "cur_dim_date", "cur_dim_product",
    "cur_fact_behaviour", "cur_fact_target",
)
ITEM_SOURCES = {
    "hist_behaviour_log": "behaviour_log",
    "hist_sales_target": "sales_target",
    "cur_dim_date": "self",
    "cur_dim_product": "behaviour_log",
    "cur_fact_behaviour": "behaviour_log",
    "cur_fact_target": "sales_target",
}


def _pick(names: tuple[str, ...], number: Column) -> Column:
    return F.element_at(F.array(*[F.lit(n) for n in names]), (number % len(names) + 1).cast("int"))


def ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run ledger: every item runs once a month, the orders of the month decide how."""
    orders = table(spark, sf_dir, "orders").select(
        ((F.year("o_orderdate") - 1990) * 12 + F.month("o_orderdate")).alias("batchID"),
        _pick(ITEMS, F.col("o_custkey")).alias("item"),
        "o_orderdate", "o_orderkey",
    )
    return orders.groupBy("batchID", "item").agg(
        F.date_format(F.min("o_orderdate"), "yyyyMMdd").alias("date"),
        F.date_format(F.min("o_orderdate"), "yyyy-MM-dd HH:mm:ss").alias("startTime"),
        F.when(F.sum("o_orderkey") % 4 == 0, "running").otherwise("complete").alias("status"),
    ).select("batchID", "date", "startTime", "item", "status")


def orchestrator_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Copy jobs of an outside orchestrator, one row per source and ship date."""
    source = _pick(("behaviour_log", "sales_target", "other"), F.col("l_orderkey"))
    return (
        table(spark, sf_dir, "lineitem")
        .select(source.alias("item"), "l_shipdate", "l_linenumber")
        .groupBy("item", "l_shipdate")
        .agg(
            F.when(F.sum("l_linenumber") % 3 == 0, "failed").otherwise("complete").alias("status")
        )
        .select(
            "item", "status", F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss").alias("endTime")
        )
    )
