"""Weekly demand, elasticity and the feature matrix of the sales forecast."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketlens.functions.calendar import previous_week, week_cycle
from basketlens.functions.columns import ratio
from basketlens.operators.regression import fit_line, fit_plane

WEEK = ["WEEK_NUMBER_CYCLE", "WEEK_NUMBER"]
CELL = ["PRODUCT_ID", *WEEK]
LAGS = (1, 2, 4)

# Count column and feature stem per kind of event.
PERSPECTIVES = {
    "purchase": ("SALES_OCCURRENCE", "SALES_OCC"),
    "view": ("VIEW_COUNT", "VIEW_CNT"),
    "cart": ("CART_COUNT", "CART_CNT"),
}
_RATIO_STEMS = {"purchase": "SALES", "view": "VIEWS", "cart": "CARTS"}
# The middle name says 2W2W although it is two weeks over four; kept as published.
_RATIOS = {"1W2W": (1, 2), "2W2W": (2, 4), "1W4W": (1, 4)}

LAG_FEATURES = [f"{stem}_PREV_{n}W" for _, stem in PERSPECTIVES.values() for n in LAGS]
RATIO_FEATURES = [
    f"{stem}_{name}_RATIO" for stem in _RATIO_STEMS.values() for name in _RATIOS
]
FEATURES = [*LAG_FEATURES, *RATIO_FEATURES]


def with_weeks(fact: DataFrame) -> DataFrame:
    """Add ISO WEEK_NUMBER, YEAR and WEEK_NUMBER_CYCLE (1 = first year seen, then 2).

    On the stored fact the first year comes from the partition column, without reading data.
    """
    day = F.col("EVENT_DATE").cast("date")
    year = F.col("PARTITIONYEAR") if "PARTITIONYEAR" in fact.columns else F.year(day)
    first_year = fact.agg(F.min(year)).scalar()
    return fact.withColumns(
        {
            "WEEK_NUMBER": F.weekofyear(day),
            "YEAR": F.year(day),
            "WEEK_NUMBER_CYCLE": week_cycle(day, first_year),
        }
    )


def top_products(events: DataFrame, k: int) -> DataFrame:
    """The k products with most purchases, ids ascending among equals."""
    return (
        events.where(F.col("EVENT_TYPE") == "purchase")
        .groupBy("PRODUCT_ID")
        .agg(F.count(F.lit(1)).alias("PURCHASES"))
        .orderBy(F.desc("PURCHASES"), "PRODUCT_ID")
        .limit(k)
    )


# Products to analyse: all, a list of ids, or a frame with a PRODUCT_ID column.
Products = Sequence[str] | DataFrame | None


def _only(df: DataFrame, products: Products) -> DataFrame:
    if products is None:
        return df
    if isinstance(products, DataFrame):
        return df.join(products.select("PRODUCT_ID"), "PRODUCT_ID", "left_semi")
    return df.where(F.col("PRODUCT_ID").isin(list(products)))


def weekly_sales(events: DataFrame, by_cycle: bool = False) -> DataFrame:
    """Per product and week: days with a purchase, mean of daily mean prices, sales scaled
    to seven days. Equal week numbers of different years fall together unless
    ``by_cycle``. Purchases without a date are dropped.

    The daily rows, at most one per product and calendar day, are laid out by product; the
    weeks, the look-back and the regressions over them then need no further shuffle.
    """
    week = WEEK if by_cycle else ["WEEK_NUMBER"]
    purchases = events.where((F.col("EVENT_TYPE") == "purchase") & F.col("EVENT_DATE").isNotNull())
    daily = purchases.groupBy("PRODUCT_ID", "EVENT_DATE").agg(
        F.count("EVENT_TYPE").alias("SALES"),
        F.avg("PRICE").alias("AVG_PRICE"),
        *[F.max(c).alias(c) for c in week],
    )
    return sales_of_days(daily, week)


def sales_of_days(daily: DataFrame, week: Sequence[str]) -> DataFrame:
    """``weekly_sales`` from one row per product and day: SALES, AVG_PRICE and the columns of the week."""
    weekly = daily.repartition("PRODUCT_ID").groupBy("PRODUCT_ID", *week).agg(
        F.count("EVENT_DATE").alias("DAYS_PURCHASED"),
        F.avg("AVG_PRICE").alias("AVG_PRICE"),
        F.sum("SALES").alias("SALES"),
    )
    return weekly.withColumns(
        {
            "SALES": F.col("SALES") / F.col("DAYS_PURCHASED") * 7,
            "PREVIOUS_WEEK_NUMBER": previous_week("WEEK_NUMBER"),
        }
    )


def with_previous_week(weekly: DataFrame) -> DataFrame:
    """Carry sales and mean price of the product's previous week (NULL where missing).

    With cycles, week 1 of cycle 2 follows week 52 of cycle 1. A product has at most 53
    weeks per cycle, so they are looked up among the product's own rows instead of by a
    second computation of the table to join with.
    """
    week, before = F.col("WEEK_NUMBER"), F.col("PREVIOUS_WEEK_NUMBER")
    if "WEEK_NUMBER_CYCLE" in weekly.columns:
        cycle = F.col("WEEK_NUMBER_CYCLE")
        week = cycle * 100 + week
        before = (cycle - F.when(F.col("WEEK_NUMBER") == 1, 1).otherwise(0)) * 100 + before
    entries = F.collect_list(F.struct(week, F.struct("SALES", "AVG_PRICE")))
    weeks = F.map_from_entries(entries.over(Window.partitionBy("PRODUCT_ID")))
    found = weekly.withColumn("__found", F.try_element_at(weeks, before))
    return found.select(
        *weekly.columns,
        F.col("__found.SALES").alias("PREVIOUS_WEEK_SALES"),
        F.col("__found.AVG_PRICE").alias("PREVIOUS_WEEK_AVG_PRICE"),
    )


def weekly_demand(events: DataFrame, by_cycle: bool = False) -> DataFrame:
    """Weekly sales next to those of the week before; weeks without one are dropped."""
    return with_previous_week(weekly_sales(events, by_cycle)).na.drop()


def elasticity_simple(demand: DataFrame, products: Products = None) -> DataFrame:
    """Per product: slope of ln sales on ln price, R2 and p-value."""
    fit = fit_line(_only(demand, products), "PRODUCT_ID", F.ln("SALES"), F.ln("AVG_PRICE"))
    return fit.select(
        "PRODUCT_ID",
        F.col("SLOPE").alias("ELASTICITY"),
        F.col("R2").alias("R2_SCORE"),
        F.col("P_VALUE").alias("COEFFICIENT_PVALUE"),
    )


def elasticity_controlled(
    demand: DataFrame, products: Products = None, *, charged_predictors: int = 3
) -> DataFrame:
    """Price slope with the previous week's sales and price held fixed."""
    fit = fit_plane(
        _only(demand, products),
        "PRODUCT_ID",
        F.ln("SALES"),
        [
            F.ln("AVG_PRICE"),
            F.ln(F.col("PREVIOUS_WEEK_SALES") + 1),
            F.ln(F.col("PREVIOUS_WEEK_AVG_PRICE") + 1),
        ],
        charged_predictors=charged_predictors,
    )
    return fit.select(
        "PRODUCT_ID",
        F.col("SLOPE").alias("ELASTICITY"),
        F.col("R2").alias("R2_SCORE"),
        F.col("P_VALUE").alias("COEFFICIENT_PVALUE"),
    )


def weekly_counts(events: DataFrame, products: Products = None) -> DataFrame:
    """Purchases, views, carts and mean purchase price per product and week, in one pass."""
    kinds = list(PERSPECTIVES)
    counts = [
        F.count_if(F.col("EVENT_TYPE") == kind).alias(name)
        for kind, (name, _) in PERSPECTIVES.items()
    ]
    price = F.avg(F.when(F.col("EVENT_TYPE") == "purchase", F.col("PRICE")))
    return (
        _only(events, products)
        .where(F.col("EVENT_TYPE").isin(kinds))
        .groupBy(*CELL)
        .agg(price.alias("MEAN_PRICE"), *counts)
    )


def _rolling(count: str, stem: str) -> dict[str, Column]:
    """Sums over the previous 1, 2 and 4 rows among the weeks in which it happened at all.

    The current row is subtracted rather than left out of the frame: the first week then
    gives 0, not NULL.
    """
    happened = F.col(count) > 0
    weeks = Window.partitionBy("PRODUCT_ID", happened).orderBy(*WEEK)
    return {
        f"{stem}_PREV_{n}W": F.when(
            happened, F.sum(count).over(weeks.rowsBetween(-n, 0)) - F.col(count)
        )
        for n in LAGS
    }


def perspective_features(
    events: DataFrame, kind: str, products: Products = None
) -> DataFrame:
    """Weekly count of one kind of event with its rolling sums (price for purchases)."""
    count, stem = PERSPECTIVES[kind]
    columns = [*CELL, *(["MEAN_PRICE"] if kind == "purchase" else []), count]
    weekly = weekly_counts(events.where(F.col("EVENT_TYPE") == kind), products).select(*columns)
    return weekly.withColumns(_rolling(count, stem))


def raw_features(events: DataFrame, products: Products = None) -> DataFrame:
    """Weeks with purchases, with the rolling sums of all three kinds and their ratios.

    One aggregate and one shuffle by product feed all nine rolling sums: each kind rolls
    over its own weeks by making "it happened" part of the window key.
    """
    return features_of_weeks(weekly_counts(events, products))


def features_of_weeks(weekly: DataFrame) -> DataFrame:
    """``raw_features`` from the rows of ``weekly_counts``."""
    weekly = weekly.repartition("PRODUCT_ID")
    for count, stem in PERSPECTIVES.values():
        weekly = weekly.withColumns(_rolling(count, stem))
    ratios = {
        f"{_RATIO_STEMS[kind]}_{name}_RATIO": ratio(f"{stem}_PREV_{a}W", f"{stem}_PREV_{b}W")
        for kind, (_, stem) in PERSPECTIVES.items()
        for name, (a, b) in _RATIOS.items()
    }
    return weekly.where("SALES_OCCURRENCE > 0").withColumns(ratios)


def log_counts(features: DataFrame) -> DataFrame:
    """Replace counts and rolling sums by their logarithm; zero becomes NULL."""
    return features.withColumns(
        {c: F.ln(F.col(c)) for c in ["SALES_OCCURRENCE", *LAG_FEATURES]}
    )


def feature_matrix(events: DataFrame, products: Products = None) -> DataFrame:
    """Log counts and ratios per product and week with purchases."""
    return log_counts(raw_features(events, products)).select(*CELL, "SALES_OCCURRENCE", *FEATURES)


def last_week(features: DataFrame) -> Column:
    """The last (cycle, week) present, as a scalar struct."""
    return features.agg(F.max(F.struct(*WEEK))).scalar()


def days_seen(events: DataFrame) -> DataFrame:
    """Per week the number of dates with an event of any kind: below 7 if the events start or end inside the week."""
    return events.select(*WEEK, "EVENT_DATE").distinct().groupBy(*WEEK).agg(F.count("EVENT_DATE").alias("DAYS_SEEN"))


def time_split(
    features: DataFrame,
    train_weeks: Sequence[int] | None = (4, 3, 2, 1),
    last_n: int | None = None,
) -> DataFrame:
    """Add SPLIT: "test" for the last week of the last cycle, "train" for training weeks.

    Training weeks are given by number, in any cycle; a test week among them is only test.
    With ``last_n`` they are the last n weeks before the test week instead. Other rows are
    dropped.
    """
    week = F.struct(*WEEK)
    is_test = week == last_week(features)
    if last_n is None:
        is_train = F.col("WEEK_NUMBER").isin(list(train_weeks))
    else:
        # The distinct weeks are bounded by the calendar: two cycles of at most 53 weeks.
        weeks = features.select(week.alias("w")).distinct()
        recent = weeks.agg(
            F.slice(F.sort_array(F.collect_list("w"), asc=False), 2, last_n)
        ).scalar()
        is_train = F.array_contains(recent, week)
    split = F.when(is_test, "test").when(is_train, "train")
    return features.withColumn("SPLIT", split).where(F.col("SPLIT").isNotNull())
