"""What is kept up batch by batch, against the same computed anew; landing that is stopped or repeated."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from basketlens.operators.ordering import as_of
from basketlens.plans import day_counts, rfm, segments, weekly
from basketlens.session import make_folder
from basketlens.sources import landing

FACT_DDL = "EVENT_DATETIME timestamp, EVENT_DATE string, EVENT_TYPE string, PRODUCT_ID string, PRICE double, USER_ID string, USER_SESSION string"


def events(days, seed=1, n=40):
    draw = random.Random(seed)
    rows = []
    for day in days:
        for _ in range(n):
            time = datetime(2024, 1, day, draw.randrange(24), draw.randrange(60))
            user = draw.choice([None, *"abcdefgh"])
            session = draw.choice([None, *(f"s{i}" for i in range(25))])
            rows.append((time, f"{time:%Y-%m-%d}", draw.choice(["purchase", "purchase", "view"]), "1", draw.randrange(1, 900) / 4, user, session))
    return rows


def dates(rows):
    return rows.select("EVENT_DATE").distinct()


def assert_as_rebuilt(kept, fact):
    ours, anew = kept.rfm("2024-02-01 00:00:00"), rfm.rfm(fact, "2024-02-01 00:00:00")
    assert sorted(map(repr, ours.collect())) == sorted(map(repr, anew.collect()))


def test_segments_follow_every_change(spark, tmp_path):
    frame = lambda rows: spark.createDataFrame(rows, FACT_DDL)
    first = events(range(1, 4)) + [(None, None, "purchase", "1", 5.0, "z", "undated")]
    undated_last = [(datetime(2024, 1, 2), None, "purchase", "1", 5.0, "z", "undated")]
    first = first[:-1] + undated_last
    kept = segments.Segments(spark, str(tmp_path / "kept"), buckets=4)
    assert kept.rfm("2024-02-01 00:00:00").collect() == []
    fact = frame(first)
    kept.update(fact, dates(fact))
    assert_as_rebuilt(kept, fact)

    # day 2 is delivered anew and day 3 loses all its purchases; sessions change buyers and end earlier
    second = [r for r in first if r[1] not in ("2024-01-02", "2024-01-03")] + events([2], seed=2) + events([4], seed=3)
    fact = frame(second)
    touched = spark.createDataFrame([("2024-01-02",), ("2024-01-03",), ("2024-01-04",)], "EVENT_DATE string")
    kept._prepare(fact, touched)  # stopped before it was complete: nothing has happened
    kept = segments.Segments(spark, str(tmp_path / "kept"), buckets=4)
    assert_as_rebuilt(kept, frame(first))
    kept._prepare(fact, touched)
    make_folder(spark, f"{kept.root}/pending/complete")  # stopped while partitions were replaced
    kept = segments.Segments(spark, str(tmp_path / "kept"), buckets=4)
    assert_as_rebuilt(kept, fact)
    kept.update(fact, touched)  # once more
    assert_as_rebuilt(kept, fact)


def test_malformed_lines(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id,name\n1,"x, ""y"""\n2\n3,z,more\nfour,w\n5,\n')
    (tmp_path / "a.json").write_text('{"id": 1, "name": "x"}\n{"id": 2, "na\n{"id": "three"}\n\n{"name": "y"}\n')
    good, bad = landing.split_malformed(spark, str(tmp_path), "csv", "id int, name string", name="*.csv")
    assert sorted(map(tuple, good.collect())) == [(1, 'x, "y"'), (5, None)]
    assert sorted(r["record"] for r in bad.collect()) == ["2", "3,z,more", "four,w"]
    good, bad = landing.split_malformed(spark, str(tmp_path), "json", "id int, name string", name="*.json")
    assert sorted(map(repr, map(tuple, good.collect()))) == ["(1, 'x')", "(None, 'y')"]
    assert bad.count() == 2 and {r["file"].rsplit("/", 1)[1] for r in bad.collect()} == {"a.json"}
    report = landing.malformed_report(bad, "t", data_date="20240101", run_ts="2024-01-01 00:00:00")
    assert report.select("primaryKeyValue").distinct().count() == 2
    with pytest.raises(ValueError):
        landing.split_malformed(spark, str(tmp_path), "parquet", "id int")


def test_files_land_once(spark, tmp_path):
    source, table, checkpoint = (str(tmp_path / name) for name in ("in", "table", "checkpoint"))

    def deliver(low, high):
        spark.range(low, high, numPartitions=3).withColumn("part", F.col("id") % 2).write.mode("append").json(source)

    def land(shape=lambda rows: rows):
        stream = landing.new_files(spark, source, "json", "id long, part long", name="*.json", max_files=2)
        return landing.land_once(shape(stream), table, checkpoint, ("part",))

    def landed():
        return sorted(r["id"] for r in spark.read.parquet(table).select("id").collect())

    deliver(0, 10)
    assert land() == 10 and landed() == list(range(10))
    assert land() == 0 and landed() == list(range(10))
    deliver(10, 20)
    stop = F.when(F.col("id") == 19, F.raise_error("stopped")).otherwise(F.col("id")).cast("long")
    with pytest.raises(Exception, match="stopped"):
        land(lambda rows: rows.withColumn("id", stop))
    assert set(landed()) < set(range(20)) and len(landed()) == len(set(landed()))
    land()
    assert landed() == list(range(20))


def test_as_of_against_plain_search(spark):
    draw = random.Random(5)
    start = datetime(2024, 1, 1)
    time = lambda: draw.choice([None, *(start + timedelta(hours=draw.randrange(200)) for _ in range(9))])
    left = [(i, draw.choice([None, "a", "b"]), time()) for i in range(80)] + [(80, "c", start)]
    right = [(draw.choice([None, "a", "b"]), time(), draw.choice([None, *range(9)])) for _ in range(60)]
    found = as_of(
        spark.createDataFrame(left, "id int, k string, t timestamp"), spark.createDataFrame(right, "k string, u timestamp, v int"),
        ["k"], "t", "u", ["u", "v"], cut=lambda t: F.date_trunc("day", t),
    )
    assert found.columns == ["id", "k", "t", "u", "v"]
    rank = lambda r: (r[1], r[2] is not None, r[2] or 0)
    for row in found.collect():
        before = [r for r in right if row.t and r[1] and r[0] == row.k and r[1] <= row.t]
        assert (row.u, row.v) == (max(before, key=rank)[1:] if before else (None, None))
    assert found.count() == len(left)
    nothing = spark.createDataFrame([], "k string, u timestamp, v int")
    empty = as_of(spark.createDataFrame(left, "id int, k string, t timestamp"), nothing, ["k"], "t", "u", ["v"], cut=lambda t: F.date_trunc("day", t))
    assert empty.where("v is null").count() == len(left)


def test_day_counts_follow_every_change(spark, tmp_path):
    frame = lambda rows: spark.createDataFrame(rows, FACT_DDL)
    first = events(range(1, 20), n=8) + [(datetime(2024, 1, 2), None, "purchase", "1", 5.0, "z", "undated")]
    kept = day_counts.DayCounts(spark, str(tmp_path / "days"))
    assert kept.weekly_sales().collect() == [] and kept.feature_matrix().collect() == []
    kept.update(frame(first), dates(frame(first)))
    second = [r for r in first if r[1] not in ("2024-01-02", "2024-01-03")] + events([2, 20], seed=2)
    touched = spark.createDataFrame([("2024-01-02",), ("2024-01-03",), ("2024-01-20",)], "EVENT_DATE string")
    kept.update(frame(second), touched)
    fact = weekly.with_weeks(frame(second))
    shown = lambda df: sorted(map(repr, df.select(*[F.round(c, 6) if t == "double" else c for c, t in df.dtypes]).collect()))
    assert shown(kept.weekly_sales()) == shown(weekly.weekly_sales(fact))
    assert shown(kept.weekly_demand(by_cycle=True)) == shown(weekly.weekly_demand(fact, by_cycle=True))
    assert shown(kept.feature_matrix()) == shown(weekly.feature_matrix(fact))


def test_changed_days_are_found_in_one_shuffle(spark):
    ddl = "s string, u string, n long, d decimal(38,6)"
    old = [("a", None, 1, None), (None, "x", 2, None), ("b", "y", 3, None), ("c", "z", 4, None)]
    new = [("a", None, 1, None), (None, "x", 2, None), ("b", "y", 5, None), (None, None, 6, None)]
    found = segments._differing(spark.createDataFrame(old, ddl), spark.createDataFrame(new, ddl))
    assert found.columns == ["s", "u", "n", "d"]
    assert sorted(r["n"] for r in found.collect()) == [3, 4, 5, 6]
    assert found._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1].count("Exchange hashpartitioning") == 1
