"""The whole chain over landed CSV files: two batches, then segments and predictions."""

import csv

from pyspark.sql import functions as F

from basketlens.operators import ledger as lg
from basketlens.plans import forecast, jobs, rfm

SOURCES = {"cur_dim_product": "behaviour_log", "cur_fact_behaviour": "behaviour_log",
           "cur_fact_target": "sales_target", "cur_dim_date": "self"}


def write_events(path, days, price="10.5"):
    path.mkdir()
    with open(path / "behaviour_log.csv", "w", newline="") as f:
        out = csv.writer(f)
        out.writerow(["event_time", "event_type", "product_id", "category_id", "category_code",
                      "brand", "price", "user_id", "user_session"])
        for day in days:
            for user in range(6):
                for n, kind in enumerate(["view", "view", "cart", "purchase"]):
                    out.writerow([
                        f"2020-01-{day:02d} 10:0{n // 2}:00 UTC", kind, str(user % 3), "7",
                        'a.b "quoted"', "", price, f"u{user}", f"s{user}-{day}",
                    ])


def test_two_batches(spark, tmp_path):
    lake = jobs.Lake(spark, str(tmp_path / "lake"))
    first = jobs.Run("20200120", "2020-01-20 00:00:00")
    write_events(tmp_path / "day1", range(1, 20))
    targets = tmp_path / "targets"
    targets.mkdir()
    (targets / "sales_target.csv").write_text(
        "Country,YearMonth,Target\nUS,202001,310\n US ,202001,310\nUS,202002,290\n,202003,1\n"
    )

    assert jobs.open_batch(lake, first) == 1
    assert not jobs.build_dim_product(lake, first)  # nothing landed yet
    assert not jobs.land_behaviour_log(lake, first, str(tmp_path / "missing"))
    assert jobs.land_sales_target(lake, first, str(targets))
    assert lake.table(jobs.AUDIT).where("exist = 'N'").count() == 1

    assert jobs.land_behaviour_log(lake, first, str(tmp_path / "day1"))
    assert jobs.build_dim_date(lake, first)
    assert lake.table("curated.dim_date").count() == 11323
    # The missing source used up batch 1; its data arrived as batch 2, which is new to batch 1.
    assert jobs.build_dim_product(lake, first)
    assert jobs.build_fact_behaviour(lake, first)
    assert jobs.build_fact_target(lake, first)
    assert jobs.build_fact_session(lake, first)
    assert jobs.analyse_rfm(lake, first)

    fact = lake.table("curated.fact_behaviour_log")
    assert fact.count() == 19 * 6 * 3  # one of the two equal views is dropped
    assert lake.table("curated.dim_product").count() == 3
    daily = lake.table("curated.fact_target")
    assert daily.groupBy("YEARMONTH").agg(F.round(F.sum("DAILYTARGET"), 6), F.count("*")).sort(
        "YEARMONTH"
    ).collect() == [(202001, 310.0, 31), (202002, 290.0, 29)]
    bad = spark.read.option("recursiveFileLookup", True).parquet(str(tmp_path / "lake/quarantine/cur_fact_target"))
    assert {tuple(r) for r in bad.select("errorType", "primaryKeyValue").distinct().collect()} == {
        ("Null value", "202003"), ("Duplicated value", "US,202001")
    }
    assert lake.table("curated.da_rfm_analysis").count() == 6

    assert jobs.update_rfm(lake, first)
    assert lake.table("curated.da_rfm_analysis").count() == 6

    # Second day: one repeated date, one new; the repeated rows are replaced, not doubled.
    second = jobs.Run("20200121", "2020-01-21 00:00:00")
    jobs.close_batch(lake)
    jobs.open_batch(lake, second)
    write_events(tmp_path / "day2", [19, 20, 27], price="11.5")
    assert jobs.land_behaviour_log(lake, second, str(tmp_path / "day2"))
    assert jobs.build_fact_behaviour(lake, second)
    fact = lake.table("curated.fact_behaviour_log")
    assert fact.count() == 21 * 6 * 3
    assert fact.groupBy("PRICE").count().sort("PRICE").collect() == [
        (10.5, 18 * 18), (11.5, 3 * 18)
    ]
    assert jobs.build_fact_session(lake, second)
    assert lake.table("curated.fact_usersession_cal").count() == 21 * 6
    assert jobs.analyse_rfm(lake, second, rel_error=0.01)
    assert lake.table("curated.da_rfm_analysis").count() == 6

    assert jobs.update_rfm(lake, second)  # reads the three dates of the second batch
    kept, anew = lake.table("curated.da_rfm_analysis"), rfm.rfm(fact, second.run_ts)
    assert kept.exceptAll(anew.select(*kept.columns)).isEmpty() and kept.count() == 6

    small = {"maxIter": [2], "numTrees": [2], "maxDepth": [2]}
    spaces = {m: {k: small.get(k, v) for k, v in space.items()} for m, space in forecast.SPACES.items()}
    search = forecast.Search(draws=2, folds=2, spaces=spaces)
    assert jobs.predict_sales(lake, second, search=search)
    predicted = lake.table("curated.ml_sales_prediction")
    assert predicted.where("SALES_PREDICTION_XG is not null").select("WEEK_NUMBER").distinct().collect() == [(5,)]
    assert predicted.groupBy("PRODUCT_ID", "WEEK_NUMBER_CYCLE", "WEEK_NUMBER").count().where("count > 1").isEmpty()

    orchestrator = spark.createDataFrame(
        [("behaviour_log", "complete", "2020-01-20 23:00:00")], "item string, status string, endTime string"
    )
    jobs.write_summaries(lake, orchestrator, SOURCES)
    jobs.close_batch(lake)
    status = lg.latest_status(lake.table(jobs.LEDGER)).where("item = 'Start'").first()["status"]
    assert status == "complete"
    logs = spark.read.option("header", True).csv(f"{lake.root}/log/2/success_summary")
    marks = {r["source"]: r["endTime"] for r in logs.collect()}
    assert marks["self"] == "2020-01-20T00:00:00.00Z"

    lake.as_views()
    spend = spark.sql(
        "SELECT d.CATEGORY, count(*) AS n FROM curated_fact_behaviour_log f "
        "JOIN curated_dim_product d ON f.PRODUCT_ID_FK = d.PRODUCT_ID_KEY "
        "WHERE f.EVENT_TYPE = 'purchase' GROUP BY d.CATEGORY"
    )
    assert [tuple(r) for r in spend.collect()] == [("a", 21 * 6)]


def test_lines_that_do_not_fit(spark, tmp_path):
    lake = jobs.Lake(spark, str(tmp_path / "lake"))
    write_events(tmp_path / "day", [1])
    with open(tmp_path / "day" / "behaviour_log.csv", "a") as f:
        f.write("2020-01-01 10:00:00 UTC,view,1\n")
    run = jobs.Run("20200101", "2020-01-01 00:00:00")
    assert not jobs.land_checked_log(lake, run, str(tmp_path / "missing"))
    assert jobs.land_checked_log(lake, run, str(tmp_path / "day"))
    assert lake.table("history.behaviour_log").count() == 24
    bad = spark.read.option("recursiveFileLookup", True).parquet(str(tmp_path / "lake/quarantine"))
    assert [r["checkFieldValue"] for r in bad.collect()] == ["2020-01-01 10:00:00 UTC,view,1"]
