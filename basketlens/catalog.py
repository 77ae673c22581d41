"""Every query by name, over the test tables of one scale factor.

Results are made comparable with SQL here and only here: doubles are rounded, times
become text, and run-time stamps and hash keys are left out where SQL cannot know them.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DecimalType, DoubleType, TimestampType

from basketlens.functions.columns import parse_day_first, parse_year_first_micros
from basketlens.operators import ledger as lg
from basketlens.operators import merge, quality
from basketlens.operators.boosting import Boosting
from basketlens.operators.ordering import as_of, keep_latest, latest_batch
from basketlens.plans import day_counts, dimensions, facts, forecast, history, rfm, segments, weekly
from basketlens.schemas import DQ_DDL, LANDED_BEHAVIOUR_DDL, create_table_sql
from basketlens.session import configure, make_folder, scratch_path, stored
from basketlens.sources import landing, readers, testdata, writers

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

ETL_TS = "2024-02-01 00:00:00"
LATER_TS = "2024-02-02 00:00:00"
STAMPS = ["PARTITIONYEAR", "PARTITIONMONTH", "PARTITIONDAY", "ETLUPDATEDDATETIME"]


def query(build: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return build(configure(spark), sf_dir)

    QUERIES[build.__name__] = run
    return build


def comparable(df: DataFrame, digits: int = 4) -> DataFrame:
    """Doubles rounded, decimals as doubles, dates and times as text.

    A nudge far below the last digit kept settles exact halves the same way in every
    engine.
    """

    def column(field):
        value = F.col(field.name)
        if isinstance(field.dataType, DoubleType):
            value = F.round(value + 1e-7, digits)
        elif isinstance(field.dataType, DecimalType):
            value = F.round(value.cast("double"), 2)
        elif isinstance(field.dataType, TimestampType):
            value = F.date_format(value, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        elif isinstance(field.dataType, DateType):
            value = F.date_format(value, "yyyy-MM-dd")
        return value.alias(field.name)

    return df.select(*[column(field) for field in df.schema.fields])


def _dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    return testdata.with_faults(testdata.behaviour_events(spark, sf_dir))


def _weeks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weekly.with_weeks(testdata.events_as_fact(spark, sf_dir))


def _sales_weeks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weekly.with_weeks(testdata.lineitem_sales(spark, sf_dir))


# --- history -----------------------------------------------------------------------------


def _landed_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events as a CSV landing presents them: lower-case names, all text."""
    events = testdata.behaviour_log(spark, sf_dir).drop("BATCHNUMBER", "event_id")
    return events.select(*[F.col(c).cast("string").alias(c.lower()) for c in events.columns])


@query
def hist_behaviour_log(spark, sf_dir):
    log = history.hist_behaviour_log(_landed_events(spark, sf_dir), batch=7)
    return comparable(log.withColumn("PRICE", F.col("PRICE").try_cast("double")))


@query
def hist_sales_target(spark, sf_dir):
    targets = testdata.sales_target(spark, sf_dir).drop("BATCHNUMBER")
    landed = targets.select(
        F.col("COUNTRY").alias("Country"),
        F.col("YEARMONTH").cast("string").alias("YearMonth"),
        F.col("TARGET").cast("decimal(20,2)").cast("string").alias("Target"),
    )
    return comparable(history.hist_sales_target(landed, 3, "2024-03-09"), 2)


@query
def latest_batch_events(spark, sf_dir):
    return comparable(latest_batch(testdata.behaviour_events(spark, sf_dir)))


# --- dimensions and facts ----------------------------------------------------------------


@query
def dim_date(spark, sf_dir):
    orders = testdata.table(spark, sf_dir, "orders")
    return comparable(dimensions.dim_date_spanning(orders, "o_orderdate"))


@query
def dim_product(spark, sf_dir):
    dim = dimensions.dim_product(testdata.behaviour_log(spark, sf_dir), ETL_TS)
    return dim.drop("PRODUCT_ID_KEY", "ETLUPDATEDDATETIME")


@query
def fact_behaviour_log(spark, sf_dir):
    fact = facts.fact_behaviour_log(_dirty(spark, sf_dir), ETL_TS)
    return comparable(fact.drop("BEHAVIOUR_KEY", "PRODUCT_ID_FK", "ETLUPDATEDDATETIME"))


@query
def fact_behaviour_view_dedupe(spark, sf_dir):
    events = facts.usable_events(_dirty(spark, sf_dir), latest_only=False)
    return comparable(facts.dedupe_views(events))


@query
def action_sequence(spark, sf_dir):
    events = facts.usable_events(_dirty(spark, sf_dir), latest_only=False)
    return comparable(facts.action_sequence(events))


@query
def action_sequence_batches(spark, sf_dir):
    """Sessions that go on in a second batch, numbered batch by batch with the last numbers carried over."""
    events = testdata.behaviour_events(spark, sf_dir).withColumn("USER_SESSION", F.concat_ws("-", "USER_ID", "EVENT_TYPE"))
    first = stored(facts.action_sequence(events.where("BATCHNUMBER = 1")), "numbered")
    carried = stored(facts.last_actions(first), "carried")
    second = facts.action_sequence(events.where("BATCHNUMBER = 2"), carried)
    return comparable(first.unionByName(second).select("USER_SESSION", "PRODUCT_ID", "PRICE", "ACTION_ITEMS"))


@query
def purchase_filter(spark, sf_dir):
    events = testdata.behaviour_events(spark, sf_dir).where(facts.drop_unpaid_purchases())
    return comparable(
        events.groupBy("EVENT_TYPE").agg(
            F.count(F.lit(1)).alias("N"), F.min("PRICE").alias("LOWEST_PRICE")
        )
    )


@query
def fact_target_daily(spark, sf_dir):
    fact = facts.fact_target(testdata.sales_target(spark, sf_dir), ETL_TS)
    return comparable(fact.drop("TARGET_KEY", *STAMPS), 2)


@query
def fact_target_deduped(spark, sf_dir):
    """Targets delivered twice for some months: the duplicates must not be split twice."""
    twice = F.when(F.col("YEARMONTH") % 7 == 0, F.array(F.lit(0), F.lit(1))).otherwise(
        F.array(F.lit(0))
    )
    doubled = testdata.sales_target(spark, sf_dir).withColumn("copy", F.explode(twice))
    fact = facts.fact_target(doubled.withColumn("TARGET", F.col("TARGET") + F.col("copy")), ETL_TS)
    return comparable(
        fact.groupBy("COUNTRY", "YEARMONTH").agg(
            F.count(F.lit(1)).alias("DAYS"),
            F.sum("DAILYTARGET").alias("MONTH_TOTAL"),
            F.max("TARGET").alias("TARGET"),
        ),
        2,
    )


@query
def fact_user_session(spark, sf_dir):
    fact = testdata.events_as_fact(spark, sf_dir)
    return comparable(facts.fact_user_session(fact, ETL_TS).drop("ETLUPDATEDDATETIME"))


@query
def hash_keys(spark, sf_dir):
    """Per product: one hash key, the seed where there is no product, and as many row keys as natural keys."""
    fact = facts.fact_behaviour_log(_dirty(spark, sf_dir), ETL_TS)
    return fact.groupBy("PRODUCT_ID").agg(
        F.countDistinct("PRODUCT_ID_FK").alias("PRODUCT_KEYS"),
        F.when(F.col("PRODUCT_ID").isNull(), F.min("PRODUCT_ID_FK").cast("string")).alias("KEY_OF_NULL"),
        F.countDistinct("BEHAVIOUR_KEY").alias("ROW_KEYS"),
        F.count(F.lit(1)).alias("N"),
    )


@query
def hash_key_consistency(spark, sf_dir):
    """Fact and dimension derive the same key: every event of a known product finds it."""
    log = testdata.behaviour_log(spark, sf_dir)
    dim = dimensions.dim_product(log, ETL_TS).select("PRODUCT_ID_KEY", "CATEGORY")
    fact = facts.fact_behaviour_log(log, ETL_TS).select("PRODUCT_ID_FK", "EVENT_TYPE")
    joined = fact.join(dim, fact["PRODUCT_ID_FK"] == dim["PRODUCT_ID_KEY"])
    return joined.groupBy("CATEGORY", "EVENT_TYPE").agg(F.count(F.lit(1)).alias("N"))


# --- segmentation ------------------------------------------------------------------------


@query
def session_baskets(spark, sf_dir):
    return comparable(rfm.session_baskets(testdata.events_as_fact(spark, sf_dir)))


@query
def shared_session_baskets(spark, sf_dir):
    """Sessions shared by all users of a day: the buyer is their number and a hash of them all."""
    fact = testdata.events_as_fact(spark, sf_dir).withColumn("USER_SESSION", F.col("EVENT_DATE"))
    several = F.contains(F.col("USER_ID"), F.lit(" users "))
    users = F.when(several, F.split_part("USER_ID", F.lit(" "), F.lit(1)).cast("long")).otherwise(F.lit(1))
    return comparable(rfm.session_baskets(fact).withColumn("USERS", users).drop("USER_ID"), 2)


def _users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rfm.user_values(stored(rfm.user_totals(testdata.events_as_fact(spark, sf_dir)), "users"))


@query
def rfm_users(spark, sf_dir):
    return comparable(_users(spark, sf_dir))


@query
def rfm_segments(spark, sf_dir):
    result = rfm.rfm(testdata.events_as_fact(spark, sf_dir), ETL_TS)
    return comparable(result.drop("USER_ID_KEY", *STAMPS))


@query
def rfm_quartiles(spark, sf_dir):
    return _cuts(rfm.rfm_quartiles(_users(spark, sf_dir)))


def _cuts(quartiles: DataFrame) -> DataFrame:
    return quartiles.select(
        *[
            F.round(F.get(F.col(m), F.lit(i)), 2).alias(f"{m}_Q{i + 1}")
            for m in rfm.METRICS
            for i in range(3)
        ]
    )


def _kept_segments(spark, sf_dir) -> segments.Segments:
    """Pairs of users share sessions that span dates. The first half of the month is delivered without some rows and with
    some that are withdrawn later, then the second half with the dates to mend, then a few dates once more."""
    fact = testdata.events_as_fact(spark, sf_dir)
    pair = (F.col("USER_ID").cast("long") / 2).cast("long")
    fact = fact.withColumn("USER_SESSION", F.concat_ws("-", pair, F.dayofmonth("EVENT_DATETIME") % 8))
    day, product = F.dayofmonth("EVENT_DATETIME"), F.col("PRODUCT_ID").cast("long")
    early, wrong = (day <= 15) & ((product % 7 != 3) | (day < 3)), (day == 9) & (product % 5 == 0)
    copies = F.array_compact(F.array(F.when(early, F.lit("right")), F.when(wrong, F.lit("wrong"))))  # one scan gives both
    other, is_wrong = F.concat("USER_ID", F.lit("x")), F.col("copy") == "wrong"
    first = fact.withColumn("copy", F.explode(copies)).withColumns(
        {
            "USER_ID": F.when(is_wrong, other).otherwise(F.col("USER_ID")),
            "PRICE": F.when(is_wrong, F.col("PRICE") + 1).otherwise(F.col("PRICE")),
        }
    ).drop("copy")
    kept = segments.Segments(spark, scratch_path(spark, "segments"), buckets=8)
    for rows, wanted in ((first, day <= 15), (fact, day >= 3), (fact, (day > 9) & (day < 20))):
        kept.update(rows, fact.where(wanted).select("EVENT_DATE").distinct())
    return kept


@query
def rfm_batches(spark, sf_dir):
    """The segmentation kept up by three deliveries, as it is over all events at once."""
    several = F.contains(F.col("USER_ID"), F.lit(" users "))
    users = F.when(several, F.split_part("USER_ID", F.lit(" "), F.lit(1)).cast("long")).otherwise(F.lit(1))
    result = _kept_segments(spark, sf_dir).rfm(ETL_TS).withColumn("USERS", users)
    return comparable(result.drop("USER_ID", "USER_ID_KEY", *STAMPS))


@query
def rfm_quartiles_batches(spark, sf_dir):
    return _cuts(_kept_segments(spark, sf_dir).quartiles())


@query
def rfm_quartiles_approx(spark, sf_dir):
    """Whether the sketch's quartiles lie within the allowed rank error of the exact ones."""
    users = stored(_users(spark, sf_dir), "values")
    cuts = rfm.rfm_quartiles(users, rel_error=0.01)
    near = {m: cuts.select(F.col(m)).scalar() for m in rfm.METRICS}
    total = F.count(F.lit(1))
    good = []
    for m in rfm.METRICS:
        value = F.col(m).cast("double")
        for i, q in enumerate(rfm.QUARTILES):
            cut = F.get(near[m], F.lit(i)).cast("double")
            low, high = F.count_if(value < cut) / total, F.count_if(value <= cut) / total
            good.append(((low <= q + 0.01) & (high >= q - 0.01)).alias(f"{m}_Q{i + 1}"))
    return users.agg(*good)


@query
def rfm_label_counts(spark, sf_dir):
    result = rfm.rfm(testdata.events_as_fact(spark, sf_dir), ETL_TS)
    return result.groupBy("RFM_LABEL").agg(
        F.count(F.lit(1)).alias("CUSTOMERS"), F.min("RFM_SCORE").alias("LOWEST_SCORE")
    )


# --- data quality ------------------------------------------------------------------------

_CHECK = {"data_date": "20240201", "run_ts": ETL_TS}
_LOG = "history.behaviour_log"


@query
def check_null(spark, sf_dir):
    key = ["EVENT_TIME", "USER_ID", "USER_SESSION"]
    events = _dirty(spark, sf_dir).withColumn(
        "EVENT_TIME", F.date_format("EVENT_TIME", "yyyy-MM-dd HH:mm:ss.SSSSSS")
    )
    return comparable(quality.check_null(events, _LOG, key, key, **_CHECK))


def _duplicates(spark, sf_dir):
    return quality.check_duplicate(
        _dirty(spark, sf_dir), _LOG, ["USER_SESSION", "EVENT_TYPE", "PRODUCT_ID"], ["event_id"],
        kind="Fact", time_column="EVENT_TIME", tie_break=["event_id"], **_CHECK,
    )


@query
def check_duplicate(spark, sf_dir):
    return comparable(_duplicates(spark, sf_dir)[0])


@query
def dedupe_latest(spark, sf_dir):
    clean = _duplicates(spark, sf_dir)[1]
    return comparable(clean.select("USER_SESSION", "EVENT_TYPE", "PRODUCT_ID", "EVENT_TIME", "PRICE"))


@query
def dedupe_dimension(spark, sf_dir):
    report, clean = quality.check_duplicate(
        testdata.behaviour_log(spark, sf_dir), _LOG, ["PRODUCT_ID"], ["PRODUCT_ID"],
        kind="Dimension", time_column="EVENT_TIME", tie_break=["event_id"], **_CHECK,
    )
    return clean.select("PRODUCT_ID", "BRAND", "event_id")


def _mapped(spark, sf_dir):
    log = testdata.behaviour_log(spark, sf_dir)
    branded = log.where("BRAND is not null").select("PRODUCT_ID").distinct()
    events = _dirty(spark, sf_dir).withColumn("PRODUCT_FK", F.col("PRODUCT_ID"))
    return quality.with_mapped_key(events, branded, "PRODUCT", "PRODUCT_ID")


@query
def check_mapping(spark, sf_dir):
    report = quality.check_mapping(
        _mapped(spark, sf_dir), "fact_behaviour_log", ["PRODUCT_Key"], ["event_id"], **_CHECK
    )
    return comparable(report)


@query
def quarantine(spark, sf_dir):
    """Reports of all checks appended to one place and read back, counted per error."""
    path = scratch_path(spark, "quarantine")
    events = _dirty(spark, sf_dir)
    writers.append_quarantine(
        quality.check_null(events, _LOG, ["USER_ID"], ["event_id"], **_CHECK), path
    )
    writers.append_quarantine(_duplicates(spark, sf_dir)[0], path)
    writers.write_json_log(spark.read.parquet(path), f"{path}-json")
    return readers.read_json(spark, f"{path}-json", DQ_DDL).groupBy(
        "errorType", "checkField"
    ).agg(F.count(F.lit(1)).alias("N"))


# --- table changes -----------------------------------------------------------------------


@query
def upsert_dim_product(spark, sf_dir):
    log = testdata.behaviour_log(spark, sf_dir)
    target = dimensions.dim_product(log.where("BATCHNUMBER = 1"), ETL_TS)
    source = dimensions.dim_product(log.where("BATCHNUMBER = 2"), LATER_TS)
    merged = merge.upsert(target, source, ["PRODUCT_ID"], unique=True)
    return comparable(merged.drop("PRODUCT_ID_KEY"))


def _spending(events: DataFrame, batch: int) -> DataFrame:
    return (
        events.where(F.col("BATCHNUMBER") == batch)
        .groupBy("USER_ID", "PRODUCT_ID")
        .agg(F.round(F.sum("PRICE"), 2).alias("SPENT"), F.max("EVENT_TIME").alias("LAST_EVENT"))
    )


@query
def upsert_conditional(spark, sf_dir):
    """Spending per user and product; a row is only replaced by an equal or higher one."""
    events = testdata.behaviour_events(spark, sf_dir)
    merged = merge.upsert(
        _spending(events, 1), _spending(events, 2), ["USER_ID", "PRODUCT_ID"],
        update_when=lambda t, s: t["SPENT"] <= s["SPENT"],
    )
    return comparable(merged)


@query
def upsert_user_session(spark, sf_dir):
    events = testdata.behaviour_events(spark, sf_dir).withColumnRenamed("EVENT_TIME", "EVENT_DATETIME")
    monthly = events.withColumn("USER_SESSION", F.concat_ws("-", "USER_ID", "EVENT_TYPE"))
    target = facts.fact_user_session(monthly.where("BATCHNUMBER = 1"), ETL_TS)
    source = facts.fact_user_session(monthly.where("BATCHNUMBER = 2"), LATER_TS)
    return comparable(merge.upsert(target, source, ["USER_SESSION"], unique=True))


@query
def session_batches(spark, sf_dir):
    """Sessions stored from the first batch, some of which go on in the second and change their date."""
    path = scratch_path(spark, "sessions")
    parts = writers.FACT_PARTITIONS
    events = testdata.behaviour_events(spark, sf_dir).withColumnRenamed("EVENT_TIME", "EVENT_DATETIME")
    monthly = events.withColumn("USER_SESSION", F.concat_ws("-", "USER_ID", "EVENT_TYPE"))
    first = facts.fact_user_session(monthly.where("BATCHNUMBER = 1"), ETL_TS)
    writers.overwrite_path(first, path, parts)
    table = spark.read.schema(first.schema).parquet(path)
    spans = facts.session_spans(monthly.where("BATCHNUMBER = 2"))
    merged = facts.user_sessions(facts.continued_spans(spans, table), LATER_TS)
    merge.upsert_moving(spark, path, merged, ["USER_SESSION"], parts)
    return comparable(spark.read.schema(first.schema).parquet(path).drop("ETLUPDATEDDATETIME"))


@query
def upsert_moving_partitions(spark, sf_dir):
    """Users filed under labels with NULL and signs that folder names escape; those of the second batch change theirs."""
    path = scratch_path(spark, "labels")
    events = testdata.behaviour_events(spark, sf_dir)
    users = lambda batch: events.where(F.col("BATCHNUMBER") == batch).groupBy("USER_ID").agg(F.count(F.lit(1)).alias("N"))
    turn = F.col("USER_ID").cast("long") % 4
    label = F.when(turn == 1, "x:1").when(turn == 2, "a/b 100%").when(turn == 3, "c=d")
    first = users(1).withColumn("LABEL", label)
    writers.overwrite_path(first, path, ["LABEL"])
    second = users(2).where(turn < 3).withColumn("LABEL", F.when(turn == 1, "y").when(turn == 2, "x:1").otherwise("a/b 100%"))
    merge.upsert_moving(spark, path, second, ["USER_ID"], ["LABEL"])
    return spark.read.schema(first.schema).parquet(path)


@query
def upsert_fact_partitions(spark, sf_dir):
    """A stored, date-partitioned fact; only the partitions of the new batch are rewritten."""
    path = scratch_path(spark, "fact")
    events = testdata.behaviour_events(spark, sf_dir)
    parts = writers.FACT_PARTITIONS
    first = facts.fact_behaviour_log(events, ETL_TS, latest_only=False)
    writers.overwrite_path(first, path, parts)
    second = facts.fact_behaviour_log(events, LATER_TS, branch="Europe")
    merge.upsert_partitions(
        spark, path, second, facts.FACT_KEY, parts,
        update_when=lambda t, s: t["EVENT_DATETIME"] <= s["EVENT_DATETIME"],
        decided_by=["EVENT_DATETIME"],
    )
    return spark.read.parquet(path).groupBy(*parts, "SALES_BRANCH").agg(F.count(F.lit(1)).alias("N"))


@query
def upsert_null_partitions(spark, sf_dir):
    """Part of the rows have no date on either side: that partition is merged like any other."""
    path = scratch_path(spark, "dated")
    events = testdata.behaviour_events(spark, sf_dir).select(
        "event_id",
        F.when(F.col("event_id") % 3 > 0, F.date_format("EVENT_TIME", "yyyy-MM-dd")).alias("DAY"),
        F.lit("old").alias("STATE"),
        "BATCHNUMBER",
    )
    old = events.where("BATCHNUMBER = 1 or event_id % 2 = 0")
    writers.overwrite_path(old.drop("BATCHNUMBER"), path, ["DAY"])
    new = events.where("BATCHNUMBER = 2").withColumn("STATE", F.lit("new")).drop("BATCHNUMBER")
    merge.upsert_partitions(
        spark, path, new.select("event_id", "STATE", "DAY"), ["event_id"], ["DAY"], decided_by=["event_id"]
    )
    table = spark.read.schema("event_id long, STATE string, DAY string").parquet(path)
    return table.groupBy("DAY", "STATE").agg(F.count(F.lit(1)).alias("N"), F.sum("event_id").alias("IDS"))


@query
def replace_by_year(spark, sf_dir):
    """Targets of all years; the years of a new delivery are replaced as a whole."""
    targets = testdata.sales_target(spark, sf_dir)
    stored = facts.fact_target(targets.withColumn("BATCHNUMBER", F.lit(1)), ETL_TS)
    fresh = facts.fact_target(targets.withColumn("TARGET", F.col("TARGET") * 2), LATER_TS)
    replaced = merge.replace_where_in(stored, fresh, "YEAR")
    return comparable(replaced.select("COUNTRY", "DATE", "DAILYTARGET", "ETLUPDATEDDATETIME"), 2)


@query
def rewrite_dim_product(spark, sf_dir):
    """Read a stored dimension, upsert into it and rewrite it in place."""
    path = scratch_path(spark, "dim")
    log = testdata.behaviour_log(spark, sf_dir)
    writers.overwrite_path(dimensions.dim_product(log.where("BATCHNUMBER = 1"), ETL_TS), path)
    source = dimensions.dim_product(log, LATER_TS)
    merge.rewrite_table(merge.upsert(spark.read.parquet(path), source, ["PRODUCT_ID"]), path)
    return comparable(spark.read.parquet(path).drop("PRODUCT_ID_KEY"))


# --- weekly demand and elasticity --------------------------------------------------------


@query
def week_cycle(spark, sf_dir):
    return (
        _sales_weeks(spark, sf_dir)
        .groupBy("YEAR", "WEEK_NUMBER_CYCLE", "WEEK_NUMBER")
        .agg(F.count(F.lit(1)).alias("N"))
    )


@query
def weekly_sales(spark, sf_dir):
    return comparable(weekly.weekly_sales(_sales_weeks(spark, sf_dir)))


@query
def previous_week_join(spark, sf_dir):
    return comparable(weekly.with_previous_week(weekly.weekly_sales(_weeks(spark, sf_dir))))


@query
def weekly_demand(spark, sf_dir):
    return comparable(weekly.weekly_demand(_sales_weeks(spark, sf_dir)))


@query
def weekly_demand_undated(spark, sf_dir):
    """Purchases of some days have lost their date: they are left out, the rest stands."""
    sales = testdata.lineitem_sales(spark, sf_dir)
    dated = F.when(F.dayofmonth(F.to_date("EVENT_DATE")) != 13, F.col("EVENT_DATE"))
    weeks = weekly.with_weeks(sales.withColumn("EVENT_DATE", dated))
    return comparable(weekly.weekly_demand(weeks))


@query
def weekly_demand_by_cycle(spark, sf_dir):
    return comparable(weekly.weekly_demand(_sales_weeks(spark, sf_dir), by_cycle=True))


@query
def elasticity_simple(spark, sf_dir):
    return comparable(weekly.elasticity_simple(weekly.weekly_demand(_sales_weeks(spark, sf_dir))))


@query
def elasticity_controlled(spark, sf_dir):
    demand = weekly.weekly_demand(_sales_weeks(spark, sf_dir))
    return comparable(weekly.elasticity_controlled(demand))


@query
def top_products(spark, sf_dir):
    return weekly.top_products(_weeks(spark, sf_dir), 10)


@query
def top_product_features(spark, sf_dir):
    """The feature matrix of the ten best-selling products only."""
    events = _weeks(spark, sf_dir)
    return comparable(weekly.feature_matrix(events, weekly.top_products(events, 10)))


def _perspective(kind: str) -> Query:
    return lambda spark, sf_dir: comparable(
        weekly.perspective_features(_weeks(spark, sf_dir), kind)
    )


for _name, _kind in {"sales_features": "purchase", "view_features": "view", "cart_features": "cart"}.items():
    _build = _perspective(_kind)
    _build.__name__ = _name
    query(_build)


@query
def feature_matrix(spark, sf_dir):
    return comparable(weekly.feature_matrix(_weeks(spark, sf_dir)))


def _kept_days(spark, sf_dir) -> day_counts.DayCounts:
    """Day counts after four deliveries: rows of old weeks come late, others are withdrawn."""
    fact = testdata.events_as_fact(spark, sf_dir)
    day, product = F.dayofmonth("EVENT_DATETIME"), F.col("PRODUCT_ID").cast("long")
    early = fact.where((day <= 15) & ((product % 7 != 3) | (day < 3)))
    wrong = fact.where((day == 9) & (product % 5 == 0)).withColumn("PRICE", F.col("PRICE") + 1)
    kept = day_counts.DayCounts(spark, scratch_path(spark, "days"))
    for rows, wanted in ((early.unionByName(wrong), day <= 15), (fact, day > 15), (fact, (day >= 3) & (day <= 15)), (fact, day == 9)):
        kept.update(rows, rows.where(wanted).select("EVENT_DATE").distinct())
    return kept


@query
def previous_week_batches(spark, sf_dir):
    return comparable(weekly.with_previous_week(_kept_days(spark, sf_dir).weekly_sales()))


@query
def feature_matrix_batches(spark, sf_dir):
    return comparable(_kept_days(spark, sf_dir).feature_matrix())


@query
def time_split(spark, sf_dir):
    split = weekly.time_split(weekly.feature_matrix(_weeks(spark, sf_dir)))
    return split.select(*weekly.CELL, "SPLIT")


@query
def time_split_recent(spark, sf_dir):
    split = weekly.time_split(weekly.feature_matrix(_sales_weeks(spark, sf_dir)), last_n=3)
    return split.select(*weekly.CELL, "SPLIT")


# --- forecasts: one published setting per model, the whole tables ---------------------------


def _predicted(scored: DataFrame, models: list[str]) -> DataFrame:
    """Whether there is a prediction and it is a possible one, in place of the model's number."""
    good = {f"SALES_PREDICTION_{m}": F.coalesce(F.col(f"SALES_PREDICTION_{m}") >= 0, F.lit(False)) for m in models}
    return scored.withColumns(good)


def _forecast(model: str) -> Query:
    def build(spark, sf_dir):
        features = weekly.raw_features(_weeks(spark, sf_dir))
        scored = forecast.forecast(features, [model], fixed=forecast.FIXED)
        return _predicted(scored, [model]).select(*weekly.CELL, "ACTUAL_SALES", f"SALES_PREDICTION_{model}")

    build.__name__ = f"forecast_{model.lower()}_fixed"
    return build


for _model in forecast.MODELS:
    query(_forecast(_model))


@query
def forecast_rmse_fixed(spark, sf_dir):
    """Whether the forest beats the forecast that next week sells like the last. The test week may be seen only in part."""
    events = _weeks(spark, sf_dir)
    features = stored(weekly.raw_features(events), "features")
    scored = forecast.forecast(features, ["RF"], fixed=forecast.FIXED)
    scored = scored.withColumn("SALES_PREDICTION_LAST__log", F.col("SALES_OCC_PREV_1W"))
    errors = forecast.holdout_rmse(forecast.as_full_weeks(scored, weekly.days_seen(events)), ["RF", "LAST"])
    return errors.agg(
        F.count(F.lit(1)).alias("MODELS"),
        (F.max(F.when(F.col("MODEL") == "RF", F.col("RMSE"))) < F.max(F.when(F.col("MODEL") == "LAST", F.col("RMSE")))).alias("BETTER"),
    )


def _first_splits(name: str, search: forecast.Search, **split) -> Query:
    """The first split of the 20 drawn settings on all folds, from all training rows and features."""

    def build(spark, sf_dir):
        rows = weekly.time_split(weekly.feature_matrix(_weeks(spark, sf_dir)), **split)
        train = rows.where("SPLIT = 'train'")
        expanding = name == "GB"
        boosting = Boosting(forecast.dealt(train, search, expanding=expanding), weekly.FEATURES, forecast.LABEL, bins=16)
        settings = [replace(s, rows=1.0, columns=1.0) for s in forecast.grown_settings(name, search)]
        found = boosting.first_splits(settings, range(search.folds), expanding=expanding).where("best is not null")
        best, cuts = F.col("best"), F.array(*[F.array(*map(F.lit, c)).cast("array<double>") for c in boosting.cuts])
        penalty = F.array(*[F.lit(s.penalty) for s in settings])[F.col("DRAW")]
        value = lambda g, n: -(best[g] / float(1 << 20)) / (best[n] + penalty)
        return comparable(
            found.withColumns({"DRAW": (F.col("fit") / search.folds).cast("int"), "FOLD": F.col("fit") % search.folds}).select(
                "DRAW",
                "FOLD",
                F.get(F.array(*map(F.lit, weekly.FEATURES)), -best.feature).alias("FEATURE"),
                F.get(F.get(cuts, -best.feature), -best.bin - 1).alias("THRESHOLD"),
                best.missing_left.alias("MISSING_LEFT"),
                best.gain.alias("GAIN"),
                best.nl.alias("LEFT_ROWS"),
                best.nr.alias("RIGHT_ROWS"),
                value("gl", "nl").alias("LEFT_VALUE"),
                value("gr", "nr").alias("RIGHT_VALUE"),
            )
        )

    build.__name__ = f"first_splits_{name.lower()}"
    return build


query(_first_splits("XG", forecast.Search()))
query(_first_splits("GB", forecast.Search(folds=3), last_n=4))  # the tables hold few weeks


@query
def search_scores_xg(spark, sf_dir):
    """The crossed search, 20 draws on 5 folds grown together, with three rounds in place of hundreds: whether each fit's
    kept trees have an error on the fold left out, and none worse on the holdout than no tree."""
    rows = weekly.time_split(weekly.feature_matrix(_weeks(spark, sf_dir)))
    search = forecast.Search(spaces={"XG": {"rounds": [3], "depth": [3]}})
    fits, _ = forecast.grown_search("XG", rows.where("SPLIT = 'train'"), search, bins=16)
    known = [
        (f.number // search.folds, f.fold, f.error() >= 0, f.held[f.best()] <= f.held[0]) for f in fits  # a row per fit
    ]
    return spark.createDataFrame(known, "DRAW int, FOLD int, JUDGED boolean, NO_WORSE boolean")


@query
def rmse_of_previous_week(spark, sf_dir):
    """The error measure on a forecast SQL can also make: last week's sales."""
    features = weekly.feature_matrix(_weeks(spark, sf_dir)).withColumn(
        "SALES_PREDICTION_LAST__log", F.col("SALES_OCC_PREV_1W")
    )
    return comparable(forecast.holdout_rmse(features, ["LAST"]))


@query
def prediction_table_fixed(spark, sf_dir):
    """The prediction table with the forest's forecast, in the order it is presented in."""
    features = stored(weekly.raw_features(_weeks(spark, sf_dir)), "features")
    scored = forecast.forecast(features, ["RF"], fixed=forecast.FIXED)
    elasticity = weekly.elasticity_simple(weekly.weekly_demand(_sales_weeks(spark, sf_dir)))
    table = forecast.prediction_table(features, scored, elasticity)
    flag = F.when(F.col("SALES_PREDICTION_RF").isNotNull(), F.col("SALES_PREDICTION_RF") >= 0)
    return forecast.in_order(comparable(table.withColumn("SALES_PREDICTION_RF", flag)))


@query
def prediction_table_history(spark, sf_dir):
    """Layout of the prediction table with last week's sales in place of a model."""
    features = weekly.raw_features(_weeks(spark, sf_dir))
    scored = weekly.time_split(features).where("SPLIT = 'test'").withColumns(
        {
            "ACTUAL_SALES": F.col("SALES_OCCURRENCE"),
            **{f"SALES_PREDICTION_{m}": F.col("SALES_OCC_PREV_1W") for m in forecast.MODELS},
        }
    )
    elasticity = weekly.elasticity_simple(weekly.weekly_demand(_sales_weeks(spark, sf_dir)))
    return comparable(forecast.prediction_table(features, scored, elasticity))


# --- run ledger --------------------------------------------------------------------------


@query
def ledger_latest_batch(spark, sf_dir):
    return lg.latest_batch_id(testdata.ledger(spark, sf_dir), "cur_dim_product")


@query
def ledger_next_batch(spark, sf_dir):
    return lg.next_batch_id(testdata.ledger(spark, sf_dir), "cur_dim_product")


@query
def ledger_next_batches(spark, sf_dir):
    return lg.next_batch_ids(testdata.ledger(spark, sf_dir))


@query
def ledger_gate(spark, sf_dir):
    return lg.gate(testdata.ledger(spark, sf_dir), ["hist_behaviour_log", "cur_dim_product"])


@query
def ledger_latest_status(spark, sf_dir):
    return lg.latest_status(testdata.ledger(spark, sf_dir))


@query
def ledger_complete(spark, sf_dir):
    ledger = testdata.ledger(spark, sf_dir)
    newest = ledger.agg(F.max("batchID")).scalar()
    return lg.complete_batch(ledger, "cur_dim_product", newest)


@query
def ledger_close(spark, sf_dir):
    return lg.close_batch(testdata.ledger(spark, sf_dir))


@query
def ledger_success_watermark(spark, sf_dir):
    return lg.success_watermark(
        testdata.ledger(spark, sf_dir), testdata.orchestrator_log(spark, sf_dir),
        testdata.ITEM_SOURCES, "cur_",
    )


@query
def runs_with_copy(spark, sf_dir):
    """Every run with the copy job before it."""
    return lg.runs_with_copy(
        testdata.ledger(spark, sf_dir), testdata.orchestrator_log(spark, sf_dir), testdata.ITEM_SOURCES
    )


@query
def event_before_purchase(spark, sf_dir):
    """Every purchase with the user's last view that is not later: the as-of match over all events."""
    events = testdata.behaviour_events(spark, sf_dir)
    views = events.where("EVENT_TYPE = 'view'").select(
        "USER_ID", F.col("EVENT_TIME").alias("VIEWED_AT"), F.col("event_id").alias("VIEW_ID")
    )
    purchases = events.where("EVENT_TYPE = 'purchase'").select("event_id", "USER_ID", "EVENT_TIME")
    day = lambda time: F.date_trunc("day", time)
    return comparable(as_of(purchases, views, ["USER_ID"], "EVENT_TIME", "VIEWED_AT", ["VIEWED_AT", "VIEW_ID"], cut=day))


@query
def ledger_batch_summary(spark, sf_dir):
    ledger = testdata.ledger(spark, sf_dir)
    return lg.batch_summary(ledger, ledger.agg(F.max("batchID")).scalar())


@query
def new_data_guard(spark, sf_dir):
    events = testdata.behaviour_events(spark, sf_dir)
    started = testdata.ledger(spark, sf_dir).agg(F.max("batchID")).scalar()
    return lg.has_new_data(events, started)


# --- sources and sinks -------------------------------------------------------------------


@query
def csv_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "csv")
    writers.write_csv(_landed_events(spark, sf_dir), path)
    source = readers.read_source(spark, path, "csv")
    log = history.hist_behaviour_log(source.rows, batch=7)
    return comparable(log.withColumn("PRICE", F.col("PRICE").try_cast("double")))


@query
def json_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "json")
    landed = _landed_events(spark, sf_dir)
    landed.write.json(path)
    rows = readers.read_source(spark, path, "json", landed.schema).rows
    return rows.groupBy("event_type", "brand").agg(F.count(F.lit(1)).alias("n"))


def _landed_lines(spark, sf_dir, kind: str) -> str:
    """Landed events as text, of which every ninth line is broken: values missing, too many, or the end cut off."""
    path = scratch_path(spark, f"lines-{kind}")
    events = testdata.behaviour_log(spark, sf_dir)
    landed = events.select("event_id", *[F.col(c).cast("string").alias(c.lower()) for c in events.columns[:9]])
    names = landed.columns[1:]
    turn = F.col("event_id") % 9
    if kind == "json":
        line = F.to_json(F.struct(*names))
        broken = F.expr("substring(line, 1, length(line) - 7)")
    else:
        line = F.concat_ws(",", *[F.coalesce(c, F.lit("")) for c in names])
        broken = F.when(F.col("event_id") % 2 == 0, F.concat("line", F.lit(",more"))).otherwise(F.substring_index("line", ",", 4))
    lines = landed.withColumn("line", line).select(
        (F.col("event_id") % 8).alias("file"), F.lit(1).alias("place"), F.when(turn == 4, broken).otherwise(F.col("line")).alias("value")
    )
    if kind == "csv":
        head = spark.range(8).select(F.col("id").alias("file"), F.lit(0).alias("place"), F.lit(",".join(names)).alias("value"))
        lines = lines.unionByName(head)
    lines = lines.repartition("file").sortWithinPartitions("file", "place").drop("place")
    lines.write.partitionBy("file").text(path)
    return path


def _malformed(kind: str) -> Query:
    def build(spark, sf_dir):
        path = _landed_lines(spark, sf_dir, kind)
        good, bad = landing.split_malformed(spark, path, kind, LANDED_BEHAVIOUR_DDL, name="*.txt")
        events = comparable(history.hist_behaviour_log(good, batch=7)).groupBy("EVENT_TYPE", "BRAND").agg(
            F.count(F.lit(1)).alias("N"), F.sum(F.col("PRODUCT_ID").cast("long")).alias("PRODUCTS")
        )
        report = landing.malformed_report(bad, _LOG, **_CHECK).groupBy("errorType").agg(F.count(F.lit(1)).alias("N"))
        return events.unionByName(
            report.select(F.col("errorType").alias("EVENT_TYPE"), F.lit(None).cast("string").alias("BRAND"), "N", F.lit(None).cast("long").alias("PRODUCTS"))
        )

    build.__name__ = f"malformed_{kind}"
    return build


for _kind in ("csv", "json"):
    query(_malformed(_kind))


@query
def landing_once(spark, sf_dir):
    """Files of two deliveries, taken over by three runs: every row is there once, under the batch that brought it."""
    path = scratch_path(spark, "stream")
    events = testdata.behaviour_log(spark, sf_dir)
    for batch in (1, 2, 3):
        rows = events.where(F.col("BATCHNUMBER") == batch).drop("BATCHNUMBER", "event_id")
        if batch < 3:  # nothing new for the third run
            rows.select(*[F.col(c).cast("string").alias(c.lower()) for c in rows.columns]).write.json(f"{path}/in/{batch}")
        stream = landing.new_files(spark, f"{path}/in", "json", LANDED_BEHAVIOUR_DDL, max_files=4)
        landing.land_once(history.hist_behaviour_log(stream, batch), f"{path}/table", f"{path}/checkpoint")
    table = spark.read.parquet(f"{path}/table")
    return table.groupBy(*writers.HISTORY_PARTITIONS, "EVENT_TYPE").agg(F.count(F.lit(1)).alias("N"))


@query
def source_audit(spark, sf_dir):
    """Audit rows of a source that exists (counted while it is read) and of one that does not."""
    run = {"batch": 7, "date": "20240201", "start_time": ETL_TS, "item": "hist_behaviour_log"}
    audits = []
    for name in ("events", "no_such_table"):
        source = readers.read_source(spark, f"{sf_dir}/{name}.parquet", "parquet")
        if source.rows is not None:
            source.rows.write.format("noop").mode("overwrite").save()
        audits.append(readers.audit_row(spark, file=name, count=source.counted, **run))
    return audits[0].unionByName(audits[1])


@query
def landing_folders(spark, sf_dir):
    """Audit rows of a folder with several CSV files, an empty folder and a missing one."""
    path = scratch_path(spark, "landing")
    writers.write_csv(_landed_events(spark, sf_dir).repartition(4), f"{path}/full")
    make_folder(spark, f"{path}/empty")
    run = {"batch": 7, "date": "20240201", "start_time": ETL_TS, "item": "hist_behaviour_log"}
    audits = []
    for name in ("full", "empty", "missing"):
        source = readers.read_source(spark, f"{path}/{name}", "csv", multiline=False)
        if source.rows is not None:
            audits.append(readers.audit_frame(source.rows, file=name, **run))
        else:
            audits.append(readers.audit_row(spark, file=name, count=None, **run))
    return audits[0].unionByName(audits[1]).unionByName(audits[2])


@query
def catalog_tables(spark, sf_dir):
    """Tables of the catalog: created, appended to twice, overwritten, and registered anew."""
    path = scratch_path(spark, "catalog")
    database = f"sinks_{path.rsplit('-', 1)[1]}"
    spark.sql(f"CREATE DATABASE {database} LOCATION '{path}/db'")
    log = stored(testdata.behaviour_log(spark, sf_dir), "log")
    for _ in range(2):
        writers.create_or_append_table(log, f"{database}.audit")
    for batch in (1, 2):
        rows = log.where(F.col("BATCHNUMBER") == batch)
        writers.overwrite_table(rows, f"{database}.overwritten", f"{path}/overwritten", ["EVENT_TYPE"])
    report = quality.check_null(_dirty(spark, sf_dir), _LOG, ["USER_ID"], ["event_id"], **_CHECK)
    for kept in (f"{path}/stale", f"{path}/bad"):
        writers.append_quarantine(report, kept)
        writers.quarantine_table(spark, f"{database}.quarantine", kept)
    writers.ensure_path(spark, log.schema, f"{path}/empty", ["EVENT_TYPE"])
    writers.ensure_path(spark, log.schema, f"{path}/empty", ["EVENT_TYPE"])
    spark.sql(create_table_sql("curated.fact_target", f"{path}/target").replace("curated.", f"{database}."))
    counts = {name: spark.table(f"{database}.{name}") for name in ("audit", "overwritten", "quarantine")}
    counts["empty"] = spark.read.schema(log.schema).parquet(f"{path}/empty")
    counts["created"] = spark.createDataFrame([(spark.catalog.tableExists(f"{database}.fact_target"),)], "made boolean").where("made")
    parts = [df.agg(F.lit(name).alias("NAME"), F.count(F.lit(1)).alias("N")) for name, df in counts.items()]
    return reduce(DataFrame.unionByName, parts)


@query
def log_files(spark, sf_dir):
    """One scan over equally named CSV files in many folders."""
    path = scratch_path(spark, "logs")
    log = testdata.orchestrator_log(spark, sf_dir)
    log.write.partitionBy("status").option("header", True).csv(path)
    return readers.read_csv(spark, path, name="part-*.csv", multiline=False).groupBy("item").agg(
        F.count(F.lit(1)).alias("n"), F.max("endTime").alias("endTime")
    )


@query
def partitioned_append(spark, sf_dir):
    path = scratch_path(spark, "history")
    landed = _landed_events(spark, sf_dir)
    for batch in (1, 2):
        writers.append_partitioned(history.hist_behaviour_log(landed, batch), path)
    return (
        readers.read_parquet(spark, path)
        .groupBy(*writers.HISTORY_PARTITIONS)
        .agg(F.count(F.lit(1)).alias("N"))
    )


@query
def parsed_times(spark, sf_dir):
    """Both text layouts of a time, and text that fits neither."""
    ts = F.col("EVENT_TIME")
    events = testdata.behaviour_events(spark, sf_dir).select(
        "event_id",
        parse_day_first(F.date_format(ts, "dd/MM/yyyy HH:mm:ss")).alias("DAY_FIRST"),
        parse_year_first_micros(F.date_format(ts, "yyyy-MM-dd HH:mm:ss.SSSSSS")).alias("MICROS"),
        parse_day_first(F.col("USER_SESSION")).alias("NO_TIME"),
    )
    return comparable(events)


@query
def latest_event_per_user(spark, sf_dir):
    events = testdata.behaviour_events(spark, sf_dir)
    latest = keep_latest(events, ["USER_ID"], "EVENT_TIME", ["event_id"])
    return comparable(latest.select("USER_ID", "event_id", "EVENT_TIME", "EVENT_TYPE", "PRICE"))


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From raw events to customer segments: history, behaviour fact, segmentation."""
    log = testdata.behaviour_log(configure(spark), sf_dir)
    fact = stored(facts.fact_behaviour_log(log, ETL_TS, latest_only=False), "fact")
    return rfm.rfm(fact, ETL_TS)


@query
def rfm_end_to_end(spark, sf_dir):
    return comparable(flagship(spark, sf_dir).drop("USER_ID_KEY", *STAMPS))
