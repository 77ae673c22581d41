import random

import pytest
from pyspark.sql import functions as F

from basketlens.operators.ordering import keep_latest, latest_batch, repeat_rows, running_total
from basketlens.plans import facts

EVENT = "EVENT_TIME timestamp, EVENT_TYPE string, PRODUCT_ID string, PRICE double, USER_ID string, USER_SESSION string"


def events(spark, rows):
    return spark.createDataFrame(
        [(t, k, p, price, u, s) for t, k, p, price, u, s in rows],
        EVENT.replace("timestamp", "string"),
    ).withColumn("EVENT_TIME", F.col("EVENT_TIME").cast("timestamp"))


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_latest_batch(spark):
    df = spark.createDataFrame([(1, "a"), (3, "b"), (3, "c"), (None, "d")], "BATCHNUMBER int, x string")
    assert sorted(r["x"] for r in latest_batch(df).collect()) == ["b", "c"]


def test_latest_batch_prunes_partitions(spark, tmp_path):
    spark.range(100).withColumn("BATCHNUMBER", F.col("id") % 4).write.partitionBy("BATCHNUMBER").parquet(str(tmp_path / "t"))
    df = latest_batch(spark.read.parquet(str(tmp_path / "t")))
    assert df.count() == 25
    assert "PartitionFilters: [isnotnull(BATCHNUMBER" in plan(df)


def test_keep_latest_is_deterministic_and_limits_before_the_shuffle(spark):
    df = spark.createDataFrame(
        [("a", 1, "x"), ("a", 2, "z"), ("a", 2, "y"), (None, 1, "n"), (None, None, "m"), ("b", None, "q")],
        "k string, t int, v string",
    )
    kept = keep_latest(df, ["k"], "t", ["v"])
    assert {(r["k"], r["v"]) for r in kept.collect()} == {("a", "y"), (None, "n"), ("b", "q")}
    text = plan(kept)
    assert text.index("WindowGroupLimit") < text.index("Exchange") < text.rindex("WindowGroupLimit")


def test_repeated_views_count_once_other_events_as_often_as_logged(spark):
    at = "2020-01-01 10:00:00"
    df = events(spark, [
        (at, "view", "1", 5.0, "u", "s"), (at, "view", "1", 4.0, "u", "s"), (at, "view", "1", None, "u", "s"),
        (at, "cart", "1", 5.0, "u", "s"), (at, "cart", "1", 5.0, "u", "s"), (at, "cart", "1", 6.0, "u", "s"),
        (at, None, "1", 5.0, "u", "s"), (at, None, "1", 5.0, "u", "s"), (at, "view", None, 5.0, "u", "s"),
    ])
    rows = facts.dedupe_views(df).groupBy("EVENT_TYPE", "PRODUCT_ID", "PRICE").count().collect()
    assert {tuple(r) for r in rows} == {
        ("view", "1", 4.0, 1), ("cart", "1", 5.0, 2), ("cart", "1", 6.0, 1), (None, "1", 5.0, 1),
        ("view", None, 5.0, 1),
    }


@pytest.mark.parametrize("seconds", [6, 1])
def test_hot_sessions_are_numbered_like_any_other(spark, seconds):
    rng = random.Random(1)
    rows = []
    for i in range(400):
        user = "hot" if i % 3 == 0 else f"u{rng.randrange(40)}"
        second = rng.randrange(seconds)
        rows.append((f"2020-01-01 10:00:0{second}.{rng.randrange(3)}", rng.choice(["view", "cart", "purchase"]),
                     str(rng.randrange(4)), float(rng.randrange(3)), user, "s"))
    df = events(spark, rows)
    numbered = facts.action_sequence(df).collect()

    expected = []
    for user in {r[4] for r in rows}:
        mine = [r for r in rows if r[4] == user]
        views = {}
        for r in mine:
            if r[1] == "view":
                key = (r[0], r[2])
                views[key] = min(r[3], views.get(key, r[3]))
        kept = [r for r in mine if r[1] != "view"]
        kept += [(t, "view", p, price, user, "s") for (t, p), price in views.items()]
        kept.sort(key=lambda r: (r[0], r[1], r[2], r[3]))
        expected += [(user, r[1], r[2], r[3], n) for n, r in enumerate(kept, 1)]
    got = [(r["USER_ID"], r["EVENT_TYPE"], r["PRODUCT_ID"], r["PRICE"], r["ACTION_ITEMS"]) for r in numbered]
    assert sorted(got) == sorted(expected)


def test_running_total_cuts_every_key_alike(spark):
    df = spark.range(200).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 50)).alias("k"),
        "id", (F.col("id") % 5 + 1).alias("w"),
    )
    levels = [{"a": F.floor(F.col("id") / 40)}, {"b": F.when(F.col("id") % 40 < 30, F.floor(F.col("id") / 7))}]
    got = running_total(df, ["k"], ["id"], "w", "sum", levels=levels)
    assert got.columns == ["k", "id", "w", "sum"]
    rows = sorted((r["id"], r["k"], r["w"]) for r in df.collect())
    totals, expected = {}, {}
    for i, k, w in rows:
        totals[k] = totals.get(k, 0) + w
        expected[i] = totals[k]
    assert {r["id"]: r["sum"] for r in got.collect()} == expected


def test_numbering_has_two_windows_over_events(spark):
    df = events(spark, [("2020-01-01 10:00:00", "cart", "1", 5.0, "u", "s")])
    levels = [{"d": F.to_date("EVENT_TIME")}, {"p": F.col("PRODUCT_ID")}]
    text = plan(running_total(df.withColumn("w", F.lit(1)), ["USER_ID"], ["PRICE"], "w", "n", levels=levels))
    assert text.count("Window [") <= 3  # one over the events, one for each level's totals


def test_heavy_copies_are_spread_in_blocks(spark):
    df = spark.createDataFrame([("a", 3, 3), ("b", 25, 30), ("c", 1, 9)], "k string, n bigint, last bigint")
    rows = repeat_rows(df, "n", "last", "i", keys=["k"], block=10)
    got = {}
    for r in rows.collect():
        got.setdefault(r["k"], []).append(r["i"])
    assert {k: sorted(v) for k, v in got.items()} == {"a": [1, 2, 3], "b": list(range(6, 31)), "c": [9]}


def test_hot_copies_keep_every_row(spark):
    at = "2020-01-01 10:00:00"
    df = events(spark, [(at, "cart", "1", 5.0, "u", "s")] * 50 + [(at, "purchase", "1", 5.0, "u", "s")] * 2)
    numbers = sorted(r["ACTION_ITEMS"] for r in facts.action_sequence(df).collect())
    assert numbers == list(range(1, 53))


def test_purchase_filter_null_rules(spark):
    df = spark.createDataFrame(
        [("purchase", 1.0), ("purchase", 0.0), ("purchase", None), ("view", None), ("view", 0.0), (None, 1.0), (None, 0.0)],
        "EVENT_TYPE string, PRICE double",
    )
    kept = {tuple(r) for r in df.where(facts.drop_unpaid_purchases()).collect()}
    assert kept == {("purchase", 1.0), ("view", None), ("view", 0.0), (None, 1.0)}


def test_running_total_shuffles_its_rows_once(spark):
    df = spark.createDataFrame([("a", 1, 5, 1), ("a", None, 7, 1), ("b", 1, 6, 1)], "k string, at int, tie int, w long")
    before = {c: spark.conf.get(c) for c in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        out = running_total(df, ["k"], ["at", "tie"], "w", "n", levels=[{"_half": F.col("at") % 2}, {"_at": F.col("at")}])
        plan = out._jdf.queryExecution().executedPlan().toString().splitlines()
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    window = next(i for i, line in enumerate(plan) if "Window [" in line and "tie#" in line)
    assert any("SortMergeJoin" in line for line in plan[:window])
    assert not any("Exchange" in line or "Sort [" in line for line in plan[:window])  # joined as the window left them
    assert sorted(map(tuple, out.select("k", "tie", "n").collect())) == [("a", 5, 1), ("a", 7, 2), ("b", 6, 1)]


def test_sums_go_on_from_their_starts(spark):
    rng = random.Random(7)
    rows = [(rng.choice("abc"), rng.choice([None, *range(30)]), i, rng.randrange(1, 4)) for i in range(300)]
    ddl = "k string, at int, tie int, w long"
    levels = [{"_ten": F.expr("at div 10")}, {"_at": F.col("at")}]

    def summed(part, starts=None):
        table = spark.createDataFrame(part, ddl).repartition(4)
        return running_total(table, ["k"], ["at", "tie"], "w", "n", levels=levels, starts=starts)

    whole = {r.tie: r.n for r in summed(rows).collect()}
    late = lambda r: r[1] is None or r[1] >= 15
    first = summed([r for r in rows if not late(r)])
    starts = first.groupBy("k").agg(F.max("n").alias("start")).where("k <> 'c'")
    second = summed([r for r in rows if late(r)], starts)
    lost = max(r.n for r in first.where("k = 'c'").collect())
    for r in first.union(second).collect():
        assert r.n == whole[r.tie] - (lost if r.k == "c" and (r.at is None or r.at >= 15) else 0)
