from pyspark.sql import functions as F

from basketlens.operators import ledger as lg

DDL = "batchID int, date string, startTime string, item string, status string"
ROWS = [
    (1, "20240101", "2024-01-01 00:00:00", "Start", "complete"),
    (1, "20240101", "2024-01-01 01:00:00", "log", "complete"),
    (1, "20240101", "2024-01-01 02:00:00", "cur_product", "complete"),
    (2, "20240102", "2024-01-02 00:00:00", "Start", "running"),
    (2, "20240102", "2024-01-02 01:00:00", "log", "complete"),
    (2, "20240102", "2024-01-02 02:00:00", "cur_product", "running"),
    (2, "20240102", "2024-01-02 03:00:00", "cur_fact", "complete"),
]
SOURCES = {"cur_product": "log", "cur_fact": "log", "cur_date": "self"}


def ledger(spark, rows=ROWS):
    return spark.createDataFrame(rows, DDL)


def test_batch_ids(spark):
    df = ledger(spark)
    assert lg.latest_batch_id(df, "log").first()[0] == 2
    assert lg.latest_batch_id(df, "never").first()[0] == 0
    assert lg.next_batch_id(df, "log").first()[0] == 3
    assert lg.next_batch_id(df, "never").first()[0] == 2  # joins the open batch
    assert lg.next_batch_id(ledger(spark, []), "log").first()[0] == 1
    assert {tuple(r) for r in lg.next_batch_ids(df).collect()} == {("Start", 3), ("log", 3), ("cur_product", 3), ("cur_fact", 3)}


def test_gate_needs_every_item_complete_by_exact_name(spark):
    df = ledger(spark)
    passed = lambda *items: lg.gate(df, items).first()[0]
    assert passed("log") and passed("log", "cur_fact")
    assert not passed("log", "cur_product") and not passed("lo") and not passed("log", "never")


def test_completing_one_run(spark):
    done = lg.complete_batch(ledger(spark), "cur_product", 2)
    assert done.where("status = 'running'").select("item").collect() == [("Start",)]


def test_closing_waits_for_running_items(spark):
    df = ledger(spark)
    assert lg.close_batch(df).exceptAll(df).isEmpty()
    closed = lg.close_batch(lg.complete_batch(df, "cur_product", 2))
    assert closed.where("status = 'running'").isEmpty()


def test_watermark_takes_the_copy_end_only_if_the_runs_started_after_it(spark):
    copies = lambda end: spark.createDataFrame(
        [("log", "complete", end), ("log", "failed", "2025-01-01 00:00:00")], "item string, status string, endTime string")
    mark = lambda end: [tuple(r) for r in lg.success_watermark(ledger(spark), copies(end), SOURCES, "cur_").collect()]
    assert mark("2023-12-31 23:00:00") == [("log", "2023-12-31T23:00:00.00Z", 1)]
    assert mark("2024-01-01 02:00:01") == [("log", "2024-01-01T02:00:00.00Z", 1)]


def test_new_data_guard(spark):
    history = spark.createDataFrame([(3,), (1,)], "BATCHNUMBER int")
    assert lg.has_new_data(history, 3).first()[0] and not lg.has_new_data(history, 4).first()[0]
    assert not lg.has_new_data(history.where("false"), 1).first()[0]


def test_summary_is_sorted(spark):
    assert [r["item"] for r in lg.batch_summary(ledger(spark), 1).collect()] == ["Start", "log", "cur_product"]
    assert lg.open_row(spark, 4, "d", "s", "x").select(F.col("status")).first()[0] == "running"
