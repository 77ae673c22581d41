"""Customer segmentation by recency, frequency and monetary value."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketlens.functions.columns import as_of_text, surrogate_key, with_partition_columns
from basketlens.functions.scoring import quartile_score, rfm_label
from basketlens.operators.quantiles import approx_quantiles, exact_quantiles
from basketlens.session import stored

QUARTILES = (0.25, 0.5, 0.75)
METRICS = ["RECENCY", "FREQUENCY", "MONETARY"]


def session_baskets(fact: DataFrame, *, list_buyers: bool = False) -> DataFrame:
    """Purchases per session: last purchase time, buyer, number of purchases, money spent.

    Several users under one session form one composite buyer, named by their number and a
    hash of all their ids, "2 users 1f3a...", whose size does not grow with them.
    ``list_buyers`` names the ids themselves instead, "u1, u2" in ascending order. The rows are
    first summed per session and user.
    """
    per_user = (
        fact.where(F.col("EVENT_TYPE") == "purchase")
        .groupBy("USER_SESSION", "USER_ID")
        .agg(
            F.max("EVENT_DATETIME").alias("DATETIME_ORDER"),
            F.count("USER_SESSION").alias("QUANTITY"),
            F.sum("PRICE").alias("SPENT_MONEY"),
        )
    )
    return baskets_of(per_user, list_buyers=list_buyers)


def baskets_of(per_user: DataFrame, *, list_buyers: bool = False) -> DataFrame:
    """``session_baskets`` from one row per session and user."""
    users, ids = F.count("USER_ID"), F.bit_xor(F.xxhash64("USER_ID"))
    composite = F.concat(users.cast("string"), F.lit(" users "), F.lower(F.hex(ids)))
    buyer = F.when(users > 1, composite).otherwise(F.coalesce(F.min("USER_ID"), F.lit("")))
    if list_buyers:
        buyer = F.concat_ws(", ", F.sort_array(F.collect_list("USER_ID")))
    return per_user.groupBy("USER_SESSION").agg(
        F.max("DATETIME_ORDER").alias("DATETIME_ORDER"),
        buyer.alias("USER_ID"),
        F.sum("QUANTITY").alias("QUANTITY"),
        F.sum("SPENT_MONEY").alias("SPENT_MONEY"),
    )


def user_totals(fact: DataFrame) -> DataFrame:
    """Per user: time of the last purchase, purchase sessions, money spent."""
    return (
        session_baskets(fact)
        .groupBy("USER_ID")
        .agg(
            F.max("DATETIME_ORDER").alias("LAST_ORDER"),
            F.count("USER_ID").alias("FREQUENCY"),
            F.sum("SPENT_MONEY").cast("decimal(30,2)").alias("MONETARY"),
        )
    )


def user_values(totals: DataFrame) -> DataFrame:
    """Recency, frequency and monetary value of every user.

    Recency is in days, counted to the day after the last purchase of all.
    """
    study_date = F.date_add(totals.agg(F.max("LAST_ORDER")).scalar().cast("date"), 1)
    return totals.select(
        "USER_ID",
        F.datediff(study_date, F.col("LAST_ORDER")).alias("RECENCY"),
        "FREQUENCY",
        "MONETARY",
    )


def rfm_quartiles(users: DataFrame, rel_error: float | None = None) -> DataFrame:
    """The quartile cuts of the three values: exact, or within a relative rank error."""
    if rel_error is None:
        return exact_quantiles(users, METRICS, QUARTILES)
    return approx_quantiles(users, METRICS, QUARTILES, rel_error)


def rfm(fact: DataFrame, etl_ts: str, rel_error: float | None = None) -> DataFrame:
    """Scores 1 (best) to 4 per value, their sum and the customer label.

    The users' totals are stored first: study date, quartiles and scores all read them, and
    the fact, which is larger by orders of magnitude, is scanned only once.
    """
    users = user_values(stored(user_totals(fact), "user-totals"))
    return segments(users, rfm_quartiles(users, rel_error), etl_ts)


def segments(users: DataFrame, quartiles: DataFrame, etl_ts: str) -> DataFrame:
    """Scores, segmentation and label of every user from the three values and their cuts."""
    cuts = quartiles.select(F.struct(*METRICS).alias("cuts")).scalar()
    scored = users.withColumns(
        {
            f"{metric[0]}_QUARTILE": quartile_score(
                F.col(metric).cast("double"), cuts[metric], low_is_best=metric == "RECENCY"
            )
            for metric in METRICS
        }
    )
    parts = [f"{metric[0]}_QUARTILE" for metric in METRICS]
    total = F.col(parts[0]) + F.col(parts[1]) + F.col(parts[2])
    result = scored.select(
        surrogate_key("USER_ID").alias("USER_ID_KEY"),
        "USER_ID",
        *METRICS,
        *parts,
        F.concat(*[F.col(p).cast("string") for p in parts]).alias("RFM_SEGMENTATION"),
        total.alias("RFM_SCORE"),
        rfm_label(total).alias("RFM_LABEL"),
        as_of_text(etl_ts).alias("ETLUPDATEDDATETIME"),
    )
    columns = [c for c in result.columns if c != "ETLUPDATEDDATETIME"]
    return with_partition_columns(result, "ETLUPDATEDDATETIME").select(
        *columns, "PARTITIONYEAR", "PARTITIONMONTH", "PARTITIONDAY", "ETLUPDATEDDATETIME"
    )
