import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from basketlens.catalog import QUERIES
from basketlens.plans import forecast, weekly

TREES = {"maxIter": [2], "numTrees": [2], "maxDepth": [2]}
SMALL = {m: {k: TREES.get(k, v) for k, v in space.items()} for m, space in forecast.SPACES.items()}
SEARCH = forecast.Search(draws=2, folds=2, spaces=SMALL)


@pytest.fixture(scope="module")
def features(spark):
    """Nine weeks of twelve products whose sales repeat from week to week."""
    days = spark.range(9 * 7).select(F.date_add(F.lit("2020-01-06").cast("date"), F.col("id").cast("int")).alias("d"), "id")
    products = spark.range(12).select(F.col("id").alias("p"))
    events = (
        days.join(products, F.lit(True))
        .withColumn("n", F.explode(F.sequence(F.lit(0), F.col("p").cast("int"))))
        .select(
            F.date_format("d", "yyyy-MM-dd").alias("EVENT_DATE"),
            F.when(F.col("n") % 3 == 2, "view").when(F.col("n") % 3 == 1, "cart").otherwise("purchase").alias("EVENT_TYPE"),
            F.col("p").cast("string").alias("PRODUCT_ID"),
            (F.col("p") + F.col("id") % 4 + 1).cast("double").alias("PRICE"),
        )
    )
    return weekly.raw_features(weekly.with_weeks(events)).cache()


@pytest.mark.parametrize("model", ["XG", "GB", "RF"])
def test_forecast_is_repeatable_and_keeps_its_keys(features, model):
    runs = [
        {r["PRODUCT_ID"]: r[f"SALES_PREDICTION_{model}"] for r in
         forecast.forecast(features, [model], SEARCH, last_n=6).collect()}
        for _ in range(2)
    ]
    assert runs[0] == runs[1] and len(runs[0]) == 12
    assert all(v is not None and v >= 0 for v in runs[0].values())
    assert runs[0]["11"] > runs[0]["0"]


def test_rmse_is_finite(features):
    scored = forecast.forecast(features, ["GB"], SEARCH, last_n=6)
    (row,) = forecast.holdout_rmse(scored, ["GB"]).collect()
    assert row["MODEL"] == "GB" and 0 <= row["RMSE"] < 5


def test_expanding_window_never_looks_back(features, monkeypatch):
    seen = []
    fit = forecast.GBTRegressor.fit

    def spy(self, rows, params=None):
        seen.append({tuple(r) for r in rows.select(*weekly.WEEK).distinct().collect()})
        return fit(self, rows, params)

    monkeypatch.setattr(forecast.GBTRegressor, "fit", spy)
    forecast.forecast(features, ["GB"], SEARCH, last_n=6)
    *searched, final = seen
    assert len(searched) == 4 and len(final) == 6  # two draws on two stretches, then all weeks
    assert sorted({len(s) for s in searched}) == [2, 4]
    assert all(max(s) < max(final) for s in searched)


def test_draws_are_seeded_and_distinct():
    draws = lambda seed: forecast._draws(
        forecast.GBTRegressor(), forecast.SPACE_GB, forecast.Search(draws=20, seed=seed))
    settings = [sorted((p.name, v) for p, v in d.items()) for d in draws(1)]
    assert len(settings) == 20 and all(settings.count(s) == 1 for s in settings)
    assert settings == [sorted((p.name, v) for p, v in d.items()) for d in draws(1)]


def test_prediction_table_replaces_the_predicted_week(spark, features):
    split = weekly.time_split(features, last_n=3).where("SPLIT = 'test'")
    scored = split.withColumns({
        "ACTUAL_SALES": F.col("SALES_OCCURRENCE"),
        **{f"SALES_PREDICTION_{m}": F.lit(5).cast("long") for m in forecast.MODELS},
    })
    elasticity = spark.createDataFrame(
        [("3", -1.5, 0.5, 0.01)], "PRODUCT_ID string, ELASTICITY double, R2_SCORE double, COEFFICIENT_PVALUE double")
    table = forecast.prediction_table(features, scored, elasticity)
    assert table.columns == forecast.OUTPUT
    assert table.count() == features.count()
    predicted = {r["PRODUCT_ID"]: r for r in table.where("SALES_PREDICTION_RF is not null").collect()}
    assert len(predicted) == 12 and predicted["3"]["ELASTICITY"] == -1.5 and predicted["4"]["ELASTICITY"] is None
    past = table.where("SALES_PREDICTION_RF is null")
    assert past.where("ELASTICITY is not null or SALES_PREDICTION_XG is not null").isEmpty()
    assert past.agg(F.max("WEEK_NUMBER")).first()[0] < predicted["3"]["WEEK_NUMBER"]


def test_whole_weeks_are_not_judged_on_two_days(spark, tmp_path):
    """Four weeks and two days of sales without a trend: noise alone makes last week's forecast the worse one."""
    draw, rows = random.Random(5), []
    for product in range(20):
        for week in range(5):
            noise = draw.uniform(0.7, 1.3)
            for day in range(7 if week < 4 else 2):
                sold = round(8 * noise) if week < 4 else 8
                time = datetime(2024, 1, 1, 12) + timedelta(days=7 * week + day)
                rows += [(time, "purchase", f'{{"k": {product}}}')] * sold
    events = spark.createDataFrame(rows, "ts timestamp_ntz, event_type string, props string")
    ids = {"event_id": F.monotonically_increasing_id() * 53 + 1, "user_id": F.lit(1).cast("long"), "value": F.lit(2.0)}
    events.coalesce(1).withColumns(ids).write.parquet(f"{tmp_path}/events.parquet")
    (row,) = QUERIES["forecast_rmse_fixed"](spark, str(tmp_path)).collect()
    assert tuple(row) == (2, True)
