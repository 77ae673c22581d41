import pytest
from pyspark.sql import functions as F

from basketlens import schemas
from basketlens.operators import merge, quality
from basketlens.sources import readers, testdata, writers
from tests.conftest import SF_DIR

STAMP = {"data_date": "20200101", "run_ts": "2020-01-02 03:04:05"}


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def pair(spark):
    target = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "k string, v int")
    source = spark.createDataFrame([("b", 20), ("c", 30), (None, 40)], "k string, v int")
    return target, source


def test_upsert_updates_inserts_and_never_matches_null(spark):
    target, source = pair(spark)
    merged = merge.upsert(target, source, ["k"])
    assert rows(merged) == rows(spark.createDataFrame(
        [("a", 1), ("b", 20), ("c", 30), (None, 3), (None, 40)], "k string, v int"))


def test_upsert_is_idempotent_on_complete_keys(spark):
    target, source = (df.where("k is not null") for df in pair(spark))
    once = merge.upsert(target, source, ["k"])
    assert rows(merge.upsert(once, source, ["k"])) == rows(once)


def test_conditional_upsert_keeps_newer_target_rows(spark):
    target = spark.createDataFrame([("a", 5), ("b", 5), ("d", 1), (None, 9)], "k string, t int")
    source = spark.createDataFrame([("a", 4), ("b", 6), ("c", 1), (None, 8)], "k string, t int")
    merged = merge.upsert(target, source, ["k"], lambda t, s: t["t"] <= s["t"])
    assert rows(merged) == rows(spark.createDataFrame(
        [("a", 5), ("b", 6), ("c", 1), ("d", 1), (None, 8), (None, 9)], "k string, t int"))


def test_conditional_upsert_of_unknown_condition_does_not_update(spark):
    target = spark.createDataFrame([("a", None)], "k string, t int")
    source = spark.createDataFrame([("a", 4)], "k string, t int")
    assert rows(merge.upsert(target, source, ["k"], lambda t, s: t["t"] <= s["t"])) == [("a", None)]


@pytest.mark.parametrize("condition", [None, lambda t, s: F.lit(True)])
def test_duplicate_source_keys_raise(spark, condition):
    target = spark.createDataFrame([("a", 1)], "k string, v int")
    source = spark.createDataFrame([("b", 1), ("b", 2)], "k string, v int")
    with pytest.raises(Exception, match="several source rows for one key"):
        merge.upsert(target, source, ["k"], condition).collect()


def test_null_source_keys_are_no_duplicates(spark):
    target = spark.createDataFrame([("a", 1)], "k string, v int")
    source = spark.createDataFrame([(None, 1), (None, 2)], "k string, v int")
    assert merge.upsert(target, source, ["k"]).count() == 3


def test_replace_where_in(spark):
    target = spark.createDataFrame([(2019, 1), (2020, 2), (2020, 3), (None, 4)], "y int, v int")
    source = spark.createDataFrame([(2020, 9)], "y int, v int")
    assert rows(merge.replace_where_in(target, source, "y")) == rows(
        spark.createDataFrame([(2019, 1), (2020, 9), (None, 4)], "y int, v int"))


def test_partition_upsert_leaves_other_partitions_alone(spark, tmp_path):
    path = str(tmp_path / "t")
    first = spark.range(40).selectExpr("id", "cast(id % 4 as int) d", "1 v")
    writers.overwrite_path(first, path, ["d"])
    untouched = {f.name for f in (tmp_path / "t" / "d=0").iterdir()}
    source = spark.createDataFrame([(1, 1, 2), (101, 1, 2), (102, 7, 2)], "id bigint, d int, v int")
    merge.upsert_partitions(spark, path, source, ["id", "d"], ["d"], decided_by=["d"])
    table = spark.read.parquet(path)
    assert table.count() == 42 and table.where("v = 2").count() == 3
    assert {f.name for f in (tmp_path / "t" / "d=0").iterdir()} == untouched
    assert [f.name for f in tmp_path.iterdir()] == ["t"]


def test_partition_upsert_keeps_rows_without_a_partition_value(spark, tmp_path):
    path = str(tmp_path / "t")
    writers.overwrite_path(spark.createDataFrame([(1, None), (2, None), (3, 5)], "id int, d int"), path, ["d"])
    source = spark.createDataFrame([(9, None), (2, None)], "id int, d int")
    merge.upsert_partitions(spark, path, source, ["id"], ["d"], decided_by=["id"])
    assert rows(spark.read.schema("id int, d int").parquet(path)) == [(1, None), (2, None), (3, 5), (9, None)]


def test_partition_upsert_prunes_the_target(spark, tmp_path):
    path = str(tmp_path / "t")
    writers.overwrite_path(spark.range(400).selectExpr("id", "cast(id % 40 as int) d"), path, ["d"])
    source = spark.createDataFrame([(1, 1), (2, 2)], "id bigint, d int")
    touched = merge.touched_partitions(spark.read.parquet(path), source, ["d"])
    assert touched.count() == 20
    plan = touched._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "array_contains" in plan.split("PartitionFilters: [")[1].split("]")[0]
    touched.collect()
    scan = touched.where("id >= 0").select("d").distinct()
    assert rows(scan) == [(1,), (2,)]


def test_partition_upsert_refuses_rows_that_could_move(spark, tmp_path):
    path = str(tmp_path / "t")
    writers.overwrite_path(spark.createDataFrame([(1, 1)], "id int, d int"), path, ["d"])
    twice = spark.createDataFrame([(1, 1), (1, 2)], "id int, d int")
    with pytest.raises(ValueError, match="determine"):
        merge.upsert_partitions(spark, path, twice, ["id", "d"], ["d"], decided_by=["id"])
    with pytest.raises(ValueError, match="decided_by"):
        merge.upsert_partitions(spark, path, twice, ["id"], ["d"], decided_by=["d"])


def test_moving_upsert_leaves_no_older_row_behind(spark, tmp_path):
    path = str(tmp_path / "t")
    writers.overwrite_path(spark.createDataFrame([(1, 1), (2, 2), (3, 2), (4, 4)], "id int, d int"), path, ["d"])
    untouched = {f.name for f in (tmp_path / "t" / "d=4").iterdir()}
    merge.upsert_moving(spark, path, spark.createDataFrame([(1, 2), (2, 5), (9, 7)], "id int, d int"), ["id"], ["d"])
    spark.catalog.refreshByPath(path)
    assert rows(spark.read.parquet(path)) == [(1, 2), (2, 5), (3, 2), (4, 4), (9, 7)]
    assert {f.name for f in (tmp_path / "t" / "d=4").iterdir()} == untouched
    assert not (tmp_path / "t" / "d=1").exists() and [f.name for f in tmp_path.iterdir()] == ["t"]


ODD_FOLDERS = [None, "x:1", "a/b", "c d", "50%", "e=f", "plain"]


@pytest.mark.parametrize("label", [*ODD_FOLDERS, ""])
def test_moving_upsert_empties_any_folder(spark, tmp_path, label):
    path, ddl = str(tmp_path / "t"), "k string, n int, d string"
    writers.overwrite_path(spark.createDataFrame([("a", 1, label), ("b", 1, "stays")], ddl), path, ["d"])
    merge.upsert_moving(spark, path, spark.createDataFrame([("a", 2, "y")], ddl), ["k"], ["d"])
    assert rows(spark.read.schema(ddl).parquet(path)) == [("a", 2, "y"), ("b", 1, "stays")]
    assert {f.name for f in (tmp_path / "t").iterdir() if f.is_dir()} == {"d=y", "d=stays"}
    back = spark.createDataFrame([("a", 3, label), ("c", 3, "")], ddl)  # an empty string lies with NULL
    merge.upsert_moving(spark, path, back, ["k"], ["d"])
    assert rows(spark.read.schema(ddl).parquet(path)) == [("a", 3, label or None), ("b", 1, "stays"), ("c", 3, None)]


def test_moving_upsert_that_stopped_is_finished_by_repeating_it(spark, tmp_path, monkeypatch):
    path, ddl = str(tmp_path / "t"), "k string, n int, d string"
    writers.overwrite_path(spark.createDataFrame([("a", 1, None), ("b", 1, "x:1"), ("c", 1, "z")], ddl), path, ["d"])
    source = spark.createDataFrame([("a", 2, "z"), ("b", 2, "z")], ddl)
    remove, calls = merge.remove_path, []

    def stops(spark, folder):
        if folder.startswith(path + "/"):
            calls.append(folder)
            raise RuntimeError("stopped")
        remove(spark, folder)

    monkeypatch.setattr(merge, "remove_path", stops)
    with pytest.raises(RuntimeError, match="stopped"):
        merge.upsert_moving(spark, path, source, ["k"], ["d"])
    assert len(calls) == 1
    monkeypatch.setattr(merge, "remove_path", remove)
    merge.upsert_moving(spark, path, source, ["k"], ["d"])
    assert rows(spark.read.schema(ddl).parquet(path)) == [("a", 2, "z"), ("b", 2, "z"), ("c", 1, "z")]


def test_rewrite_moves_rows_between_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    writers.overwrite_path(spark.createDataFrame([(1, 1), (2, 1)], "id int, d int"), path, ["d"])
    source = spark.createDataFrame([(1, 2), (2, 2)], "id int, d int")
    merge.rewrite_table(merge.upsert(spark.read.parquet(path), source, ["id"]), path, ["d"])
    assert rows(spark.read.parquet(path)) == [(1, 2), (2, 2)]


def test_null_report(spark):
    df = spark.createDataFrame([("a", None), (None, "x"), ("b", "y"), (None, None)], "p string, q string")
    report = quality.check_null(df, "T", ["p", "q"], ["p"], **STAMP)
    got = {(r["checkFieldValue"], r["primaryKeyValue"]) for r in report.collect()}
    assert got == {("a", "a"), ("x", ""), ("", "")}
    first = report.first()
    assert first["errorType"] == "Null value" and first["checkField"] == "p,q"
    assert first["errorMessage"] == "The Column(s) p,q of the Table T is null"
    assert str(first["runDate"]) == "2020-01-02 03:04:05"
    assert quality.check_null(df, "T", ["p", "q"], ["p"], where="q = 'y'", **STAMP).isEmpty()


def duplicate(df, kind="Fact"):
    return quality.check_duplicate(
        df, "T", ["k", "l"], ["k"] if kind == "Dimension" else ["k", "l"], kind=kind,
        time_column="t", tie_break=["v"], **STAMP)


def test_duplicates_report_whole_groups_and_keep_the_latest(spark):
    df = spark.createDataFrame(
        [("a", "1", 1, "old"), ("a", "1", 2, "p"), ("a", "1", 2, "q"), ("b", None, 1, "x"), ("b", None, 3, "y"),
         (None, "b", 1, "z"), ("c", "1", 9, "only")],
        "k string, l string, t int, v string")
    report, clean = duplicate(df)
    assert report.count() == 5  # three of (a,1), two of (b,NULL); (NULL,b) is another key
    assert {r["errorMessage"] for r in report.collect()} == {
        "The Column(s) k,l of the Table T have duplicated value: [a,1]",
        "The Column(s) k,l of the Table T have duplicated value: [b]",
    }
    assert {(r["k"], r["v"]) for r in clean.collect()} == {("a", "p"), ("b", "y"), (None, "z"), ("c", "only")}
    assert clean.columns == df.columns


def test_quarantine_and_clean_cover_the_input(spark):
    df = spark.range(60).selectExpr("cast(id % 7 as string) k", "cast(id % 3 as string) l", "cast(id as int) t", "'' v")
    report, clean = duplicate(df)
    groups = df.select("k", "l").distinct().count()
    assert clean.count() == groups == clean.select("k", "l").distinct().count()
    assert report.count() == 60  # 21 groups over 60 rows: every group repeats


def test_dimension_duplicates_keep_one_row_per_primary_key(spark):
    df = spark.createDataFrame([("a", "1", 1, "x"), ("a", "2", 1, "y"), ("b", "1", 1, "z")], "k string, l string, t int, v string")
    report, clean = duplicate(df, "Dimension")
    assert report.isEmpty() and rows(clean.select("k", "v")) == [("a", "x"), ("b", "z")]


def test_mapping_report(spark):
    fact = spark.createDataFrame([(1, "a"), (2, "b"), (3, None), (4, "a"), (5, "b")], "id int, P_FK string")
    dim = spark.createDataFrame([("a",), ("c",)], "code string")
    mapped = quality.with_mapped_key(fact, dim, "P", "code")
    assert {(r["id"], r["P_Key"]) for r in mapped.collect()} == {(1, "a"), (2, None), (3, None), (4, "a"), (5, None)}
    report = quality.check_mapping(mapped, "F", ["P_Key"], ["id"], **STAMP)
    assert rows(report.select("primaryKeyValue", "checkFieldValue", "errorMessage")) == [
        ("2", "b", "The Column(s) P_Key of the Table F is invalid"),
        ("5", "b", "The Column(s) P_Key of the Table F is invalid"),
    ]


def test_csv_with_line_breaks_and_quotes(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_text('A,b\n"1\n2","say ""hi"""\n,x\n')
    source = readers.read_source(spark, str(tmp_path / "in"), "csv")
    assert rows(source.rows) == rows(spark.createDataFrame([("1\n2", 'say "hi"'), (None, "x")], "A string, b string"))
    assert source.counted == 2


def test_missing_source_is_audited(spark, tmp_path):
    source = readers.read_source(spark, str(tmp_path / "none"), "parquet")
    assert source.rows is None and source.counted is None
    row = readers.audit_row(spark, batch=1, date="d", start_time="s", item="i", file="f", count=source.counted).first()
    assert (row["count"], row["exist"]) == ("N/A", "N")
    with pytest.raises(ValueError):
        readers.read_source(spark, str(tmp_path), "xml")


def test_audit_frame_counts_lazily(spark):
    audit = readers.audit_frame(spark.range(7), batch=1, date="d", start_time="s", item="i", file="f")
    assert tuple(audit.first()) == ("1", "d", "s", "i", "7", "f", "Y")


def test_named_files_below_a_tree_in_one_scan(spark, tmp_path):
    for run in ("a", "b"):
        (tmp_path / run).mkdir()
        (tmp_path / run / "log.csv").write_text(f"item,n\n{run},1\n")
        (tmp_path / run / "other.csv").write_text("item,n\nzzz,1\n")
    assert rows(readers.read_csv(spark, str(tmp_path), name="log.csv").select("item")) == [("a",), ("b",)]


def test_json_log_only_when_there_are_bad_rows(spark, tmp_path):
    assert not writers.write_json_log(spark.range(0), str(tmp_path / "empty"))
    assert not (tmp_path / "empty").exists()
    assert writers.write_json_log(spark.range(3), str(tmp_path / "some"))
    assert readers.read_json(spark, str(tmp_path / "some")).count() == 3


def test_catalog_tables(spark, tmp_path):
    name = "tables_test"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    writers.overwrite_table(spark.range(3), name, str(tmp_path / "t"))
    writers.create_or_append_table(spark.range(2), name)
    assert spark.table(name).count() == 5
    writers.append_quarantine(spark.range(4), str(tmp_path / "q"))
    writers.quarantine_table(spark, name, str(tmp_path / "q"))
    assert spark.table(name).count() == 4
    spark.sql(f"DROP TABLE {name}")


def test_ensure_path_creates_an_empty_partitioned_table_once(spark, tmp_path):
    path = str(tmp_path / "t")
    schema = spark.createDataFrame([(1, 2)], "a int, d int").schema
    writers.ensure_path(spark, schema, path, ["d"])
    assert spark.read.schema(schema).parquet(path).isEmpty()
    writers.append_partitioned(spark.createDataFrame([(1, 2)], schema), path, ["d"])
    writers.ensure_path(spark, schema, path, ["d"])
    assert spark.read.parquet(path).count() == 1


def test_all_tables_can_be_created_and_filled(spark, tmp_path):
    schemas.create_tables(spark, str(tmp_path))
    for name, parts in schemas.PARTITIONING.items():
        stored = spark.table(name)
        assert stored.isEmpty()
        assert sorted(stored.columns) == sorted(schemas.schema(name).names)
        columns = [r["name"] for r in [c._asdict() for c in spark.catalog.listColumns(name)] if r["isPartition"]]
        assert columns == list(parts)
    path = str(tmp_path / "history" / "sales_target")
    row = spark.createDataFrame([("US", 202001, 1.0, 1, 2020, 1, 1)], schemas.schema("history.sales_target"))
    writers.append_partitioned(row, path)
    assert spark.read.parquet(path).count() == 1
    for name in schemas.PARTITIONING:
        spark.sql(f"DROP TABLE {name}")


def test_scratch_folder_follows_the_session(spark, monkeypatch):
    from basketlens.session import scratch_path

    class Conf(dict):
        def get(self, key, default=None):
            return dict.get(self, key, default)

    class Context:
        getCheckpointDir = staticmethod(lambda: None)

    class Fake:
        conf = Conf({"spark.master": "spark://x", "spark.checkpoint.dir": "hdfs://shared/dir/"})
        sparkContext = Context

    assert scratch_path(Fake, "n").startswith("hdfs://shared/dir/basketlens-n-")
    Fake.conf = Conf({"spark.master": "spark://x"})
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_path(Fake, "n")


def test_behaviour_log_sends_only_products_in_use_to_the_driver(spark):
    log = testdata.behaviour_log(spark, SF_DIR)
    used = log.agg(F.count_distinct("PRODUCT_ID")).first()[0]
    assert used < testdata.table(spark, SF_DIR, "part").count()
    log.collect()

    def sent(node):
        kind = node.getClass().getSimpleName()
        if kind.endswith("QueryStageExec"):
            return sent(node.plan())
        own = [node.metrics().apply("numOutputRows").value()] if kind == "BroadcastExchangeExec" else []
        below = node.children()
        return own + [n for i in range(below.size()) for n in sent(below.apply(i))]

    rows = sent(log._jdf.queryExecution().executedPlan().executedPlan())
    assert rows and max(rows) <= used
