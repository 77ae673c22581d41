"""Behaviour, daily target and user session facts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketlens.functions.columns import (
    as_of_text,
    piped,
    surrogate_key,
    trim_strings,
    with_partition_columns,
)
from basketlens.operators.ordering import keep_latest, latest_batch, repeat_rows, running_total
from basketlens.operators.quality import no_null
from basketlens.session import stored

SESSION = ["USER_ID", "USER_SESSION"]
FACT_KEY = ["EVENT_DATETIME", "EVENT_TYPE", "USER_ID", "USER_SESSION", "ACTION_ITEMS"]
ACTION_KEY = ["EVENT_TIME", "EVENT_TYPE", "USER_ID", "ACTION_ITEMS"]
TIE_BREAK = ["USER_SESSION", "PRODUCT_ID", "PRICE"]
_RAW = ["EVENT_TIME", "EVENT_TYPE", "PRODUCT_ID", "PRICE", *SESSION]


def usable_events(history: DataFrame, latest_only: bool = True) -> DataFrame:
    """Typed events of the latest batch with a time, a user and a session."""
    events = latest_batch(history) if latest_only else history
    return events.select(
        F.col("EVENT_TIME").try_cast("timestamp").alias("EVENT_TIME"),
        "EVENT_TYPE",
        "PRODUCT_ID",
        F.col("PRICE").try_cast("double").alias("PRICE"),
        *SESSION,
    ).where(no_null(["EVENT_TIME", *SESSION]))


def collapse_repeats(events: DataFrame) -> DataFrame:
    """One row per distinct event, with the number of ``COPIES`` that count.

    A repeated view (same user, session, time and product) counts once, at its lowest
    price; any other event counts as often as it was logged. Copies are merged before the
    shuffle, so a block of identical rows costs one row per input task. An event without
    a type is treated like a view.
    """
    is_view = F.coalesce(F.col("EVENT_TYPE") == "view", F.lit(True))
    keys = [*SESSION, "EVENT_TIME", "EVENT_TYPE", "PRODUCT_ID"]
    return (
        events.withColumn("__price", F.when(~is_view, F.col("PRICE")))
        .groupBy(*keys, "__price")
        .agg(F.min("PRICE").alias("PRICE"), F.count(F.lit(1)).alias("COPIES"))
        .withColumn("COPIES", F.when(is_view, F.lit(1).cast("long")).otherwise(F.col("COPIES")))
        .drop("__price")
    )


def dedupe_views(events: DataFrame) -> DataFrame:
    """Events with repeated views removed."""
    collapsed = collapse_repeats(events).withColumn("LAST", F.col("COPIES"))
    return repeat_rows(collapsed, "COPIES", "LAST", "N", keys=SESSION).drop("N").select(*_RAW)


def action_sequence(events: DataFrame, carried: DataFrame | None = None) -> DataFrame:
    """Number the events of each user session by time (ACTION_ITEMS), views deduplicated.

    Equal times are ordered by type, product and price. Every session is cut by day, second
    and moment with type and product, and numbered arithmetically from the totals of these. The
    events without their copies are stored first, since both the totals and the rows read them, and the
    numbered ones next, since single rows and blocks of copies are written out apart.

    ``carried`` (``last_actions`` of the batches before) lets a session that goes on be numbered on from where it stood. Batches
    in order of time are numbered like one; an event that is late, or a view repeated from an earlier batch, gets a new number at the end.
    """
    collapsed = stored(collapse_repeats(events), "collapsed")
    levels = [
        {"__day": F.to_date("EVENT_TIME")},
        {"__second": F.date_trunc("second", "EVENT_TIME")},
        {"EVENT_TIME": F.col("EVENT_TIME"), "EVENT_TYPE": F.col("EVENT_TYPE"), "PRODUCT_ID": F.col("PRODUCT_ID")},
    ]
    numbered = running_total(collapsed, SESSION, ["PRICE"], "COPIES", "LAST", levels=levels, starts=carried)
    numbered = stored(numbered, "numbered")
    return repeat_rows(numbered, "COPIES", "LAST", "ACTION_ITEMS", keys=SESSION).select(
        *_RAW, F.col("ACTION_ITEMS").cast("int").alias("ACTION_ITEMS")
    )


def last_actions(numbered: DataFrame, carried: DataFrame | None = None) -> DataFrame:
    """(session, start): the last number of every session, of this batch or of those before: the state to carry on."""
    last = numbered.select(*SESSION, F.col("ACTION_ITEMS").cast("long").alias("start"))
    last = last if carried is None else last.unionByName(carried.select(*SESSION, "start"))
    return last.groupBy(*SESSION).agg(F.max("start").alias("start"))


def drop_unpaid_purchases():
    """Keeps everything but purchases at a price of zero or less, or without a price."""
    return (F.col("EVENT_TYPE") != "purchase") | (F.col("PRICE") > 0)


def keyed_events(events: DataFrame, etl_ts: str, *, branch: str = "America") -> DataFrame:
    """Numbered events as fact rows: keys, date parts, unpaid purchases dropped."""
    key = piped("EVENT_TIME", "EVENT_TYPE", "PRODUCT_ID", *SESSION, "ACTION_ITEMS")
    fact = events.where(drop_unpaid_purchases()).select(
        surrogate_key(key).alias("BEHAVIOUR_KEY"),
        surrogate_key("PRODUCT_ID").alias("PRODUCT_ID_FK"),
        F.col("EVENT_TIME").alias("EVENT_DATETIME"),
        F.date_format("EVENT_TIME", "yyyy-MM-dd").alias("EVENT_DATE"),
        F.date_format("EVENT_TIME", "HH:mm:ss").alias("EVENT_TIME"),
        F.dayofweek("EVENT_TIME").alias("EVENT_WEEKDAY"),
        "EVENT_TYPE",
        "PRODUCT_ID",
        "PRICE",
        *SESSION,
        "ACTION_ITEMS",
        F.lit(branch).alias("SALES_BRANCH"),
    )
    return with_partition_columns(fact, "EVENT_DATETIME").withColumn(
        "ETLUPDATEDDATETIME", as_of_text(etl_ts)
    )


def fact_behaviour_log(
    history: DataFrame,
    etl_ts: str,
    *,
    branch: str = "America",
    latest_only: bool = True,
) -> DataFrame:
    """Cleaned, numbered and keyed events."""
    events = action_sequence(usable_events(history, latest_only))
    unique = keep_latest(events, ACTION_KEY, "EVENT_TIME", TIE_BREAK)
    return keyed_events(unique, etl_ts, branch=branch)


def usable_targets(history: DataFrame) -> DataFrame:
    """Trimmed targets of the latest batch with a country and a month."""
    return trim_strings(latest_batch(history)).where(no_null(["COUNTRY", "YEARMONTH"]))


def fact_target(history: DataFrame, etl_ts: str) -> DataFrame:
    """One row per country and day, the month's target split evenly over its days.

    Of several targets for one country and month the lowest is kept.
    """
    targets = keep_latest(
        usable_targets(history).withColumn("TARGET", F.col("TARGET").try_cast("double")),
        ["COUNTRY", "YEARMONTH"],
        "BATCHNUMBER",
        ["TARGET"],
    )
    month = F.try_to_date(F.col("YEARMONTH").cast("string"), "yyyyMM")
    days = (
        targets.withColumn("MONTH_START", month)
        .withColumn("DATE", F.explode(F.sequence("MONTH_START", F.last_day("MONTH_START"))))
        .withColumn("ETLUPDATEDDATETIME", as_of_text(etl_ts))
    )
    result = days.select(
        surrogate_key(F.concat_ws("|", "COUNTRY", "DATE")).alias("TARGET_KEY"),
        "COUNTRY",
        "DATE",
        F.col("YEARMONTH").cast("int").alias("YEARMONTH"),
        F.year("DATE").alias("YEAR"),
        F.month("DATE").alias("MONTH"),
        F.dayofmonth("DATE").alias("DAY"),
        (F.col("TARGET") / F.dayofmonth(F.last_day("DATE"))).alias("DAILYTARGET"),
        "TARGET",
        "ETLUPDATEDDATETIME",
    )
    partitioned = with_partition_columns(result, "ETLUPDATEDDATETIME")
    return partitioned.select(
        *[c for c in partitioned.columns if c != "ETLUPDATEDDATETIME"], "ETLUPDATEDDATETIME"
    )


def session_spans(fact: DataFrame) -> DataFrame:
    """First and last event of every session."""
    return (
        fact.select("EVENT_DATETIME", "USER_SESSION")
        .groupBy("USER_SESSION")
        .agg(
            F.max("EVENT_DATETIME").alias("MAX_EVENT_DATETIME"),
            F.min("EVENT_DATETIME").alias("MIN_EVENT_DATETIME"),
        )
    )


def continued_spans(spans: DataFrame, sessions: DataFrame) -> DataFrame:
    """``spans`` of new events, widened by what is stored of the same sessions."""
    known = sessions.select(
        "USER_SESSION",
        F.col("MAX_EVENT_DATETIME").alias("__max"),
        F.col("MIN_EVENT_DATETIME").alias("__min"),
    )
    return spans.join(known, "USER_SESSION", "left").select(
        "USER_SESSION",
        F.greatest("MAX_EVENT_DATETIME", "__max").alias("MAX_EVENT_DATETIME"),
        F.least("MIN_EVENT_DATETIME", "__min").alias("MIN_EVENT_DATETIME"),
    )


def user_sessions(spans: DataFrame, etl_ts: str) -> DataFrame:
    """Sessions with the minutes between first and last event (whole seconds)."""
    seconds = F.unix_timestamp("MAX_EVENT_DATETIME") - F.unix_timestamp("MIN_EVENT_DATETIME")
    sessions = spans.select(
        F.date_trunc("day", "MAX_EVENT_DATETIME").alias("DATE_KEY"),
        "USER_SESSION",
        "MAX_EVENT_DATETIME",
        "MIN_EVENT_DATETIME",
        (seconds / 60).alias("USER_SESSION_DURATION"),
    )
    return with_partition_columns(sessions, "DATE_KEY").withColumn(
        "ETLUPDATEDDATETIME", as_of_text(etl_ts)
    )


def fact_user_session(fact: DataFrame, etl_ts: str) -> DataFrame:
    """Sessions of all events."""
    return user_sessions(session_spans(fact), etl_ts)
