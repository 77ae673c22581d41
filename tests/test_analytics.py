import datetime as dt
import math
import random

import numpy as np
import pytest
import xxhash
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from basketlens.functions.calendar import week_cycle
from basketlens.functions.columns import parse_day_first, parse_year_first_micros, piped, ratio, surrogate_key
from basketlens.functions.scoring import quartile_score, rfm_label
from basketlens.functions.stats import two_sided_t
from basketlens.operators.quantiles import approx_quantiles, exact_quantiles
from basketlens.operators.regression import fit_line, fit_plane
from basketlens.plans import dimensions, facts, rfm, weekly


# --- calendar ----------------------------------------------------------------------------


def test_calendar_agrees_with_the_c_library_on_every_day(spark):
    rows = dimensions.dim_date(spark).sort("Date_Key").collect()
    day = dt.date(2019, 1, 1)
    assert len(rows) == 11323
    for r in rows:
        expected = (
            day.year, 1 if day.month < 6 else 2, (day.month + 2) // 3, day.month, day.strftime("%b"),
            int(day.strftime("%Y%m")), int(day.strftime("%U")), day.day, int(day.strftime("%w")),
        )
        assert tuple(r)[1:10] == expected
        day += dt.timedelta(days=1)
    assert day == dt.date(2050, 1, 1)


def test_half_year_boundary_is_a_parameter(spark):
    june = dimensions.dim_date(spark, "2020-06-01", "2020-06-01", half_year_last_month=6).first()
    assert june["HalfYear"] == 1


def test_week_cycle_around_the_turn_of_the_year(spark):
    days = ["2019-01-01", "2019-12-29", "2019-12-30", "2020-01-01", "2021-01-01", "2021-06-01"]
    df = spark.createDataFrame([(d,) for d in days], "d string").select(F.col("d").cast("date").alias("d"))
    got = df.select(F.weekofyear("d"), week_cycle(F.col("d"), F.lit(2019))).collect()
    assert [tuple(r) for r in got] == [(1, 1), (52, 1), (1, 2), (1, 2), (53, 2), (22, 2)]


# --- small functions ---------------------------------------------------------------------


def test_time_texts(spark):
    df = spark.createDataFrame([("31/12/2019 23:59:58", "2019-12-31 23:59:58.123456"), ("2019", ""), (None, None)], "a string, b string")
    got = df.select(parse_day_first("a").cast("string"), parse_year_first_micros("b").cast("string")).collect()
    assert [tuple(r) for r in got] == [("2019-12-31 23:59:58", "2019-12-31 23:59:58.123456"), (None, None), (None, None)]


def test_keys_are_seeded_64_bit_hashes(spark):
    row = spark.createDataFrame([("abc", None)], "p string, q string").select(
        surrogate_key("p").alias("k"), surrogate_key(piped("p", "q")).alias("n"), piped("p", "p").alias("t")).first()
    assert row["k"] == np.int64(np.uint64(xxhash.xxh64(b"abc", seed=42).intdigest()))
    assert (row["n"], row["t"]) == (42, "abc|abc")


def test_ratio_of_zero_is_null(spark):
    df = spark.createDataFrame([(1, 0), (1, 4), (None, 1)], "a int, b int").select(ratio("a", "b"))
    assert [r[0] for r in df.collect()] == [None, 0.25, None]


# Two-sided tail probabilities as printed in tables of the t distribution.
@pytest.mark.parametrize("t, df, p", [
    (12.706, 1, 0.05), (4.303, 2, 0.05), (3.182, 3, 0.05), (2.776, 4, 0.05), (2.571, 5, 0.05),
    (2.228, 10, 0.05), (3.169, 10, 0.01), (2.009, 50, 0.05), (1.980, 120, 0.05), (1.962, 1000, 0.05),
    (-2.228, 10, 0.05), (0.0, 7, 1.0),
])
def test_t_tail(spark, t, df, p):
    got = spark.range(1).select(two_sided_t(F.lit(t), F.lit(df))).first()[0]
    assert got == pytest.approx(p, abs=2e-4)


def test_t_tail_without_freedom_is_null(spark):
    df = spark.createDataFrame([(1.0, 0), (None, 5)], "t double, v int").select(two_sided_t(F.col("t"), F.col("v")))
    assert [r[0] for r in df.collect()] == [None, None]


# --- quantiles ---------------------------------------------------------------------------


@pytest.mark.parametrize("n, bracket", [(1, 1e-3), (7, 1e-3), (150, 1e-3), (4000, 0.02), (30000, 1e-3)])
def test_exact_quantiles(spark, n, bracket):
    rng = np.random.default_rng(n)
    columns = {"a": rng.normal(size=n), "b": rng.integers(0, 5, n).astype(float), "c": np.repeat(3.5, n)}
    df = spark.createDataFrame(list(zip(*(c.tolist() for c in columns.values()))), list(columns)).repartition(5)
    probabilities = [0.1, 0.25, 0.5, 0.75, 1.0]
    got = exact_quantiles(df, list(columns), probabilities, bracket).first()
    for name, values in columns.items():
        ordered = np.sort(values)
        assert got[name] == [ordered[max(0, math.ceil(p * n) - 1)] for p in probabilities]


def test_quantiles_ignore_null_and_follow_one_dominant_value(spark):
    df = spark.range(9000).select(F.when(F.col("id") % 3 == 0, 7.0).when(F.col("id") % 3 == 1, F.col("id").cast("double")).alias("v"))
    values = sorted([7.0] * 3000 + [float(i) for i in range(9000) if i % 3 == 1])
    got = exact_quantiles(df, ["v"], [0.25, 0.5, 0.75]).first()["v"]
    assert got == [values[math.ceil(p * 6000) - 1] for p in (0.25, 0.5, 0.75)]


def test_approximate_quantiles_stay_within_their_error(spark):
    df = spark.range(20000).select((F.col("id") * 7919 % 20000).cast("double").alias("v"))
    for p, v in zip((0.25, 0.5, 0.75), approx_quantiles(df, ["v"], [0.25, 0.5, 0.75], 0.01).first()["v"]):
        assert abs(v / 20000 - p) <= 0.01


# --- regression --------------------------------------------------------------------------


def regression_rows():
    rng = np.random.default_rng(5)
    rows = []
    for key, n in (("p", 30), ("q", 11), ("short", 4), ("two", 2)):
        x = rng.normal(size=(n, 3))
        y = 1.0 - 1.5 * x[:, 0] + 0.4 * x[:, 1] + rng.normal(scale=0.3, size=n)
        rows += [(key, float(b), *map(float, a)) for a, b in zip(x, y)]
    rows += [("flat", 2.0, float(i), float(i * i), 1.0 / (i + 1)) for i in range(8)]
    rows += [("line", float(i % 3), float(i), 2.0 * i, float(i * i)) for i in range(9)]
    return rows


def least_squares(rows, key, predictors):
    y = np.array([r[1] for r in rows if r[0] == key])
    x = np.array([[1.0, *r[2 : 2 + predictors]] for r in rows if r[0] == key])
    beta = np.linalg.lstsq(x, y, rcond=None)[0]
    rss = float(((y - x @ beta) ** 2).sum())
    error = math.sqrt(rss / (len(y) - predictors - 1) * np.linalg.inv(x.T @ x)[1, 1])
    return beta[1], 1 - rss / float(((y - y.mean()) ** 2).sum()), beta[1] / error, len(y) - predictors - 1


def test_fits_agree_with_least_squares(spark):
    rows = regression_rows()
    df = spark.createDataFrame(rows, "k string, y double, x0 double, x1 double, x2 double")
    xs = [F.col(f"x{i}") for i in range(3)]
    fits = {1: fit_line(df, "k", F.col("y"), xs[0]), 3: fit_plane(df, "k", F.col("y"), xs)}
    for predictors, fit in fits.items():
        by_key = {r["k"]: r for r in fit.collect()}
        for key in ("p", "q"):
            slope, r2, t, v = least_squares(rows, key, predictors)
            r = by_key[key]
            p = spark.range(1).select(two_sided_t(F.lit(float(t)), F.lit(v))).first()[0]
            assert (r["SLOPE"], r["R2"]) == pytest.approx((slope, r2), rel=1e-9)
            assert r["P_VALUE"] == pytest.approx(p, abs=1e-9)
        assert by_key["two"]["SLOPE"] is None and by_key["flat"]["SLOPE"] is None
        assert by_key["two"]["N"] == 2
    plane = {r["k"]: r for r in fits[3].collect()}
    assert plane["short"]["SLOPE"] is None  # no degree of freedom left
    assert plane["line"]["SLOPE"] is None  # collinear predictors


def test_charging_fewer_predictors_only_changes_the_p_value(spark):
    df = spark.createDataFrame(regression_rows(), "k string, y double, x0 double, x1 double, x2 double").where("k = 'q'")
    xs = [F.col(f"x{i}") for i in range(3)]
    strict, loose = fit_plane(df, "k", F.col("y"), xs).first(), fit_plane(df, "k", F.col("y"), xs, charged_predictors=1).first()
    assert strict["SLOPE"] == loose["SLOPE"] and strict["P_VALUE"] > loose["P_VALUE"]


def test_fit_agrees_with_spark_ml(spark):
    rows = [r for r in regression_rows() if r[0] == "q"]
    df = spark.createDataFrame(rows, "k string, y double, x0 double, x1 double, x2 double")
    vectors = VectorAssembler(inputCols=["x0", "x1", "x2"], outputCol="features").transform(df)
    model = LinearRegression(labelCol="y").fit(vectors)
    ours = fit_plane(df, "k", F.col("y"), [F.col(f"x{i}") for i in range(3)]).first()
    assert ours["SLOPE"] == pytest.approx(model.coefficients[0], rel=1e-6)
    assert ours["R2"] == pytest.approx(model.summary.r2, rel=1e-6)
    assert ours["P_VALUE"] == pytest.approx(model.summary.pValues[0], abs=1e-6)


# --- segmentation ------------------------------------------------------------------------

FACT = "EVENT_DATETIME timestamp, EVENT_TYPE string, PRICE double, USER_ID string, USER_SESSION string"


def purchases(spark, rows):
    return spark.createDataFrame(
        [(dt.datetime.fromisoformat(t), kind, price, u, s) for t, kind, price, u, s in rows], FACT)


def test_baskets_join_the_users_of_a_session_in_order(spark):
    df = purchases(spark, [
        ("2020-01-01T10:00", "purchase", 1.5, "u2", "s"), ("2020-01-02T10:00", "purchase", 2.0, "u1", "s"),
        ("2020-01-01T11:00", "purchase", 1.0, "u2", "s"), ("2020-01-09T10:00", "view", 9.0, "u3", "s"),
    ])
    (bounded,) = rfm.session_baskets(df).collect()
    assert bounded["USER_ID"].startswith("2 users ") and len(bounded["USER_ID"]) < 30
    row = rfm.session_baskets(df, list_buyers=True).first()
    assert tuple(row) == ("s", dt.datetime(2020, 1, 2, 10), "u1, u2", 3, 4.5)


def test_user_values_count_sessions_and_days_to_the_day_after_the_last_purchase(spark):
    df = purchases(spark, [
        ("2020-01-01T23:59", "purchase", 1.0, "a", "s1"), ("2020-01-03T00:01", "purchase", 2.0, "a", "s2"),
        ("2020-01-03T00:02", "purchase", 2.5, "a", "s2"), ("2020-01-05T12:00", "purchase", 4.0, "b", "s3"),
        ("2020-02-01T12:00", "view", 4.0, "b", "s4"),
    ])
    got = {r["USER_ID"]: (r["RECENCY"], r["FREQUENCY"], float(r["MONETARY"])) for r in rfm.user_values(rfm.user_totals(df)).collect()}
    assert got == {"a": (3, 2, 5.5), "b": (1, 1, 4.0)}


def test_scores_put_the_boundary_into_the_lower_band(spark):
    df = spark.createDataFrame([(v,) for v in (1.0, 2.0, 2.5, 4.0, 5.0)], "v double")
    cuts = F.array(F.lit(1.0), F.lit(2.0), F.lit(4.0))
    got = df.select(quartile_score(F.col("v"), cuts, low_is_best=True), quartile_score(F.col("v"), cuts, low_is_best=False))
    assert [tuple(r) for r in got.collect()] == [(1, 4), (2, 3), (3, 2), (3, 2), (4, 1)]


def test_labels(spark):
    got = [r[0] for r in spark.range(3, 13).select(rfm_label(F.col("id"))).collect()]
    assert got == ["Champions", "Loyal Customers", "Potential Loyalist", "Promising", "About To Sleep",
                   "Can’t Lose Them", "Hibernating", "Lost", "Lost", "Lost"]


def test_rfm_is_one_python_free_plan(spark):
    rng = random.Random(3)
    df = purchases(spark, [
        (f"2020-01-{rng.randrange(1, 29):02d}T10:00", "purchase", rng.randrange(1, 9) / 4, f"u{rng.randrange(40)}", f"s{rng.randrange(200)}")
        for _ in range(500)
    ])
    result = rfm.rfm(df, "2020-03-01 00:00:00")
    rows = result.collect()
    assert all(r["RFM_SCORE"] == r["R_QUARTILE"] + r["F_QUARTILE"] + r["M_QUARTILE"] for r in rows)
    assert all(3 <= r["RFM_SCORE"] <= 12 and len(r["RFM_SEGMENTATION"]) == 3 for r in rows)
    text = result._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in text and "Pandas" not in text


# --- facts -------------------------------------------------------------------------------


def test_daily_targets_add_up_and_bad_months_drop(spark):
    df = spark.createDataFrame(
        [(" US ", 202002, 290.0, 1), ("US", 202002, 290.0, 1), ("DE", 202013, 1.0, 1), (None, 202001, 1.0, 1), ("FR", 201912, 62.0, 1), ("FR", 201901, 1.0, 0)],
        "COUNTRY string, YEARMONTH int, TARGET double, BATCHNUMBER int")
    got = facts.fact_target(df, "2020-01-01 00:00:00").groupBy("COUNTRY", "YEARMONTH").agg(
        F.count("*"), F.round(F.sum("DAILYTARGET"), 6))
    assert {tuple(r) for r in got.collect()} == {("US", 202002, 29, 290.0), ("FR", 201912, 31, 62.0)}


def test_session_across_midnight_belongs_to_its_last_day(spark):
    df = purchases(spark, [("2020-01-31T23:59:30", "view", 1.0, "u", "s"), ("2020-02-01T00:01:00.900", "view", 1.0, "u", "s")])
    row = facts.fact_user_session(df, "2020-03-01 00:00:00").first()
    assert row["DATE_KEY"] == dt.datetime(2020, 2, 1)
    assert row["USER_SESSION_DURATION"] == 1.5  # whole seconds
    assert (row["PARTITIONYEAR"], row["PARTITIONMONTH"], row["PARTITIONDAY"]) == (2020, 2, 1)


def test_short_category_codes_fill_up(spark):
    df = spark.createDataFrame(
        [("1", "c", "a.b", None, 1), ("2", "c", None, "x", 1), ("3", "c", "a.b.c.d.e", "x", 1), (None, "c", "a", "x", 1), ("1", "b", "z", "y", 0)],
        "PRODUCT_ID string, CATEGORY_ID string, CATEGORY_CODE string, BRAND string, BATCHNUMBER int")
    got = {r["PRODUCT_ID"]: tuple(r)[3:8] for r in dimensions.dim_product(df, "2020-01-01 00:00:00").collect()}
    assert got == {"1": ("a", "b", "N/A", "N/A", "N/A"), "2": ("N/A",) * 4 + ("x",), "3": ("a", "b", "c", "d", "x")}


# --- weekly ------------------------------------------------------------------------------


def weekly_events(spark, rows):
    df = spark.createDataFrame(rows, "EVENT_DATE string, EVENT_TYPE string, PRODUCT_ID string, PRICE double")
    return weekly.with_weeks(df)


def test_unmatched_previous_week_is_kept_by_the_join_and_dropped_by_demand(spark):
    df = weekly_events(spark, [
        ("2020-01-06", "purchase", "p", 2.0), ("2020-01-06", "purchase", "p", 4.0), ("2020-01-07", "purchase", "p", 6.0),
        ("2020-01-14", "purchase", "p", 5.0), ("2020-01-14", "view", "p", 9.0), ("2020-02-03", "purchase", "p", 1.0),
    ])
    joined = {r["WEEK_NUMBER"]: r for r in weekly.with_previous_week(weekly.weekly_sales(df)).collect()}
    assert joined[2]["SALES"] == pytest.approx(3 / 2 * 7) and joined[2]["AVG_PRICE"] == pytest.approx(4.5)
    assert joined[3]["PREVIOUS_WEEK_SALES"] == joined[2]["SALES"]
    assert joined[2]["PREVIOUS_WEEK_SALES"] is None and joined[6]["PREVIOUS_WEEK_SALES"] is None
    assert [r["WEEK_NUMBER"] for r in weekly.weekly_demand(df).collect()] == [3]


def test_week_one_follows_week_52(spark):
    df = weekly_events(spark, [("2019-12-23", "purchase", "p", 2.0), ("2020-01-01", "purchase", "p", 3.0), ("2019-01-02", "purchase", "p", 8.0)])
    merged = {r["WEEK_NUMBER"]: r for r in weekly.weekly_demand(df).collect()}
    assert merged[1]["PREVIOUS_WEEK_AVG_PRICE"] == 2.0
    split = weekly.weekly_demand(df, by_cycle=True).collect()
    assert [(r["WEEK_NUMBER_CYCLE"], r["WEEK_NUMBER"]) for r in split] == [(2, 1)]


def test_rolling_sums_follow_each_kinds_own_weeks(spark):
    days = {2: "2020-01-06", 3: "2020-01-13", 4: "2020-01-20", 5: "2020-01-27"}
    rows = [(days[w], "purchase", "p", 1.0) for w in (2, 2, 4, 5)]
    rows += [(days[w], "view", "p", 1.0) for w in (2, 3, 3, 3, 4)]
    df = weekly_events(spark, rows)
    got = {r["WEEK_NUMBER"]: r for r in weekly.raw_features(df).collect()}
    assert set(got) == {2, 4, 5}
    assert [got[w]["SALES_OCC_PREV_1W"] for w in (2, 4, 5)] == [0, 2, 1]
    assert [got[w]["SALES_OCC_PREV_4W"] for w in (2, 4, 5)] == [0, 2, 3]
    assert [got[w]["VIEW_CNT_PREV_1W"] for w in (2, 4, 5)] == [0, 3, None]
    assert [got[w]["VIEW_CNT_PREV_2W"] for w in (2, 4, 5)] == [0, 4, None]
    assert got[2]["SALES_1W2W_RATIO"] is None and got[4]["VIEWS_1W2W_RATIO"] == 0.75
    assert got[4]["CART_CNT_PREV_1W"] is None
    logs = {r["WEEK_NUMBER"]: r for r in weekly.feature_matrix(df).collect()}
    assert logs[2]["SALES_OCC_PREV_1W"] is None and logs[4]["SALES_OCC_PREV_1W"] == pytest.approx(math.log(2))
    for kind, name in (("purchase", "SALES_OCC"), ("view", "VIEW_CNT")):
        alone = {r["WEEK_NUMBER"]: r for r in weekly.perspective_features(df, kind).collect()}
        for w in set(alone) & set(got):
            assert alone[w][f"{name}_PREV_2W"] == got[w][f"{name}_PREV_2W"]


def test_time_split(spark):
    df = weekly_events(spark, [(d, "purchase", "p", 1.0) for d in ("2019-11-04", "2020-01-06", "2020-01-13", "2020-01-27", "2020-02-03")])
    features = weekly.raw_features(df)
    by = lambda split: {(r["WEEK_NUMBER_CYCLE"], r["WEEK_NUMBER"]): r["SPLIT"] for r in split.collect()}
    assert by(weekly.time_split(features)) == {(2, 6): "test", (2, 2): "train", (2, 3): "train"}
    assert by(weekly.time_split(features, last_n=4)) == {
        (2, 6): "test", (2, 5): "train", (2, 3): "train", (2, 2): "train", (1, 45): "train"}
    assert by(weekly.time_split(features, last_n=1)) == {(2, 6): "test", (2, 5): "train"}


def test_product_filter(spark):
    df = weekly_events(spark, [("2020-01-06", "purchase", p, 1.0) for p in "pqr"])
    assert {r["PRODUCT_ID"] for r in weekly.feature_matrix(df, ["p", "q"]).collect()} == {"p", "q"}


def test_top_products_settle_ties_by_id(spark):
    df = weekly_events(spark, [("2020-01-06", k, p, 1.0) for k, p in [("purchase", "b"), ("purchase", "a"), ("purchase", "c"), ("purchase", "c"), ("view", "z")]])
    top = weekly.top_products(df, 2)
    assert [tuple(r) for r in top.collect()] == [("c", 2), ("a", 1)]
    assert {r["PRODUCT_ID"] for r in weekly.feature_matrix(df, top).collect()} == {"a", "c"}


# --- what reaches the scan ---------------------------------------------------------------


def test_stored_fact_is_filtered_and_pruned_at_the_scan(spark, tmp_path):
    path = str(tmp_path / "fact")
    df = spark.createDataFrame(
        [("2020-01-06 10:00:00", "purchase", "p", 1.0, "u", "s", 2020, "x"), ("2021-01-06 10:00:00", "view", "p", 1.0, "u", "s", 2021, "x")],
        "EVENT_DATETIME string, EVENT_TYPE string, PRODUCT_ID string, PRICE double, USER_ID string, USER_SESSION string, PARTITIONYEAR int, OTHER string",
    ).withColumns({"EVENT_DATETIME": F.col("EVENT_DATETIME").cast("timestamp"), "EVENT_DATE": F.substring("EVENT_DATETIME", 1, 10)})
    df.write.partitionBy("PARTITIONYEAR").parquet(path)
    fact = spark.read.parquet(path)

    text = rfm.user_totals(fact)._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(EVENT_TYPE,purchase)" in text
    assert "PRODUCT_ID" not in text and "OTHER" not in text
    weeks = weekly.with_weeks(fact)
    text = weekly.weekly_sales(weeks)._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(EVENT_TYPE,purchase)" in text and "OTHER" not in text
    # The first year is read from the partition folders alone.
    assert "ReadSchema: struct<>" in weeks._jdf.queryExecution().executedPlan().toString()
    assert {(r["WEEK_NUMBER_CYCLE"], r["WEEK_NUMBER"]) for r in weeks.collect()} == {(1, 2), (2, 1)}
