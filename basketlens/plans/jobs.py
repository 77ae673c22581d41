"""The nightly jobs: each reads stored tables, runs one plan and stores its result.

Nothing here schedules anything. A caller runs the functions in order (open, history,
curated, analysis, close); each records itself in the run ledger and does nothing when a
table it needs has not been completed.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from basketlens import schemas
from basketlens.operators import ledger as lg
from basketlens.operators import merge, quality
from basketlens.operators.ordering import latest_batch
from basketlens.plans import dimensions, facts, forecast, history, rfm, segments, weekly
from basketlens.session import configure, stored
from basketlens.sources import landing, readers, writers

LEDGER, AUDIT = "tempdb.batch_ledger", "tempdb.source_audit"


@dataclass(frozen=True)
class Run:
    """When a batch runs: data date (yyyyMMdd) and run time (yyyy-MM-dd HH:mm:ss)."""

    date: str
    run_ts: str


class Lake:
    """The stored tables below one root folder."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = configure(spark)
        self.root = root.rstrip("/")
        for name in (LEDGER, AUDIT):
            self.ensure(name)

    def path(self, name: str) -> str:
        return f"{self.root}/{name.replace('.', '/')}"

    def table(self, name: str) -> DataFrame:
        return self.spark.read.schema(schemas.schema(name)).parquet(self.path(name))

    def as_views(self) -> None:
        """Offer every stored table to SQL as a temporary view, ``curated_dim_date`` and so on."""
        for name in schemas.PARTITIONING:
            self.ensure(name).createOrReplaceTempView(name.replace(".", "_"))

    def ensure(self, name: str) -> DataFrame:
        """The table, created empty on first use."""
        parts = schemas.PARTITIONING[name]
        writers.ensure_path(self.spark, schemas.schema(name), self.path(name), parts)
        return self.table(name)

    def replace(self, name: str, rows: DataFrame) -> None:
        merge.rewrite_table(rows, self.path(name), schemas.PARTITIONING[name])

    # --- ledger: a few rows per batch ----------------------------------------------------

    def start(self, item: str, run: Run) -> int:
        batch = lg.next_batch_id(self.table(LEDGER), item).first()["batchID"]
        row = lg.open_row(self.spark, batch, run.date, run.run_ts, item)
        writers.append_partitioned(row, self.path(LEDGER), schemas.PARTITIONING[LEDGER])
        return batch

    def finish(self, item: str, batch: int) -> None:
        runs = self.table(LEDGER).where(F.col("item") == item)
        self.update_ledger(lg.complete_batch(runs, item, batch))

    def update_ledger(self, rows: DataFrame) -> None:
        merge.rewrite_partitions(rows, self.path(LEDGER), schemas.PARTITIONING[LEDGER])

    def ready(self, items: Sequence[str]) -> bool:
        return not items or lg.gate(self.table(LEDGER), items).first()["passed"]

    # --- data quality --------------------------------------------------------------------

    def quarantine(self, item: str, batch: int, *reports: DataFrame) -> None:
        """Keep the bad rows of a run, as a table and, if there are any, as a JSON log.

        Only the new batch is checked: bad rows of earlier ones are in their own reports.
        """
        path = f"{self.root}/quarantine/{item}/{batch}"
        for report in reports:
            writers.append_quarantine(report, path)
        writers.write_json_log(self.spark.read.parquet(path), f"{self.root}/log/{item}-{batch}")


def _job(
    lake: Lake, run: Run, item: str, needs: Sequence[str], work: Callable[[int], bool]
) -> bool:
    """Run ``work`` as the next batch of ``item``; False if it has to wait or had no data."""
    if not lake.ready(needs):
        return False
    batch = lake.start(item, run)
    worked = work(batch)
    lake.finish(item, batch)
    return worked


def open_batch(lake: Lake, run: Run) -> int:
    return lake.start(lg.START, run)


def close_batch(lake: Lake) -> None:
    closed = lg.close_batch(lake.table(LEDGER))
    lake.update_ledger(closed.where(F.col("item") == lg.START))


def _land(
    lake: Lake,
    run: Run,
    item: str,
    table: str,
    path: str,
    kind: str,
    shape: Callable[[DataFrame, int], DataFrame],
    schema: str | None = None,
    **options,
) -> bool:
    """Append a landed source to its history table, counting it while it is written.

    A missing or empty folder ends the job with an audit row that says so.
    """

    def work(batch: int) -> bool:
        source = readers.read_source(lake.spark, path, kind, schema, **options)
        if source.rows is not None:
            writers.append_partitioned(shape(source.rows, batch), lake.path(table))
        audit = readers.audit_row(
            lake.spark, batch=batch, date=run.date, start_time=run.run_ts, item=item,
            file=path.rstrip("/").rsplit("/", 1)[-1], count=source.counted,
        )
        audit.write.mode("append").parquet(lake.path(AUDIT))
        return bool(source.counted)

    return _job(lake, run, item, [], work)


def land_behaviour_log(lake: Lake, run: Run, path: str, kind: str = "csv", **options) -> bool:
    """Large CSV files are read by many tasks; ``multiline=True`` is for values with line breaks.

    JSON is read with the known columns, which saves a pass; CSV takes them from its header.
    """
    if kind == "csv":
        options.setdefault("multiline", False)
    return _land(
        lake, run, "hist_behaviour_log", "history.behaviour_log", path, kind,
        history.hist_behaviour_log, schemas.LANDED_BEHAVIOUR_DDL if kind == "json" else None, **options,
    )


def land_checked_log(lake: Lake, run: Run, path: str, kind: str = "csv") -> bool:
    """Like ``land_behaviour_log`` for lines of the known columns; records that do not fit them go to the bad-row table."""

    def work(batch: int) -> bool:
        table = "history.behaviour_log"
        exists = readers.read_source(lake.spark, path, kind, schemas.LANDED_BEHAVIOUR_DDL).rows is not None
        count = None
        if exists:
            good, bad = landing.split_malformed(lake.spark, path, kind, schemas.LANDED_BEHAVIOUR_DDL)
            report = landing.malformed_report(bad, table, data_date=run.date, run_ts=run.run_ts)
            lake.quarantine("hist_behaviour_log", batch, report)
            writers.append_partitioned(history.hist_behaviour_log(good, batch), lake.path(table))
            count = good.count()
        audit = readers.audit_row(
            lake.spark, batch=batch, date=run.date, start_time=run.run_ts, item="hist_behaviour_log",
            file=path.rstrip("/").rsplit("/", 1)[-1], count=count,
        )
        audit.write.mode("append").parquet(lake.path(AUDIT))
        return bool(count)

    return _job(lake, run, "hist_behaviour_log", [], work)


def land_sales_target(lake: Lake, run: Run, path: str, kind: str = "csv", **options) -> bool:
    return _land(
        lake, run, "hist_sales_target", "history.sales_target", path, kind,
        lambda rows, batch: history.hist_sales_target(rows, batch, run.run_ts[:10]), **options,
    )


def build_dim_date(lake: Lake, run: Run) -> bool:
    def work(batch: int) -> bool:
        writers.overwrite_path(dimensions.dim_date(lake.spark), lake.path("curated.dim_date"))
        return True

    return _job(lake, run, "cur_dim_date", [], work)


def _fresh(lake: Lake, name: str, batch: int) -> bool:
    return lg.has_new_data(lake.table(name), batch).first()["has_new_data"]


def build_dim_product(lake: Lake, run: Run) -> bool:
    def work(batch: int) -> bool:
        log = lake.table("history.behaviour_log")
        if not _fresh(lake, "history.behaviour_log", batch):
            return False
        nulls = quality.check_null(
            latest_batch(log), "history.behaviour_log", ["PRODUCT_ID"], ["PRODUCT_ID"],
            data_date=run.date, run_ts=run.run_ts,
        )
        lake.quarantine("cur_dim_product", batch, nulls)
        name = "curated.dim_product"
        merged = merge.upsert(
            lake.ensure(name), dimensions.dim_product(log, run.run_ts), ["PRODUCT_ID"], unique=True
        )
        lake.replace(name, merged)
        return True

    return _job(lake, run, "cur_dim_product", ["hist_behaviour_log"], work)


def build_fact_behaviour(lake: Lake, run: Run) -> bool:
    """New events into the fact: only the dates of the new batch are rewritten."""

    def work(batch: int) -> bool:
        log = lake.table("history.behaviour_log")
        if not _fresh(lake, "history.behaviour_log", batch):
            return False
        key = ["EVENT_TIME", "USER_ID", "USER_SESSION"]
        stamp = {"data_date": run.date, "run_ts": run.run_ts}
        numbered = stored(facts.action_sequence(facts.usable_events(log)), "numbered")
        nulls = quality.check_null(
            latest_batch(log), "history.behaviour_log", key, key, **stamp
        )
        duplicates, unique = quality.check_duplicate(
            numbered, "history.behaviour_log", facts.ACTION_KEY, facts.ACTION_KEY, kind="Fact",
            time_column="EVENT_TIME", tie_break=facts.TIE_BREAK, **stamp,
        )
        lake.quarantine("cur_fact_behaviour", batch, nulls, duplicates)
        name = "curated.fact_behaviour_log"
        lake.ensure(name)
        fact = facts.keyed_events(unique, run.run_ts)
        merge.upsert_partitions(
            lake.spark, lake.path(name), fact.select(*schemas.schema(name).names), facts.FACT_KEY,
            schemas.PARTITIONING[name], _not_older, decided_by=["EVENT_DATETIME"],
        )
        return True

    return _job(lake, run, "cur_fact_behaviour", ["hist_behaviour_log"], work)


def _not_older(target: dict[str, Column], source: dict[str, Column]) -> Column:
    return target["EVENT_DATETIME"] <= source["EVENT_DATETIME"]


def build_fact_target(lake: Lake, run: Run) -> bool:
    def work(batch: int) -> bool:
        targets = lake.table("history.sales_target")
        if not _fresh(lake, "history.sales_target", batch):
            return False
        key = ["COUNTRY", "YEARMONTH"]
        stamp = {"data_date": run.date, "run_ts": run.run_ts}
        duplicates, _ = quality.check_duplicate(
            facts.usable_targets(targets), "history.sales_target", key, key, kind="Fact",
            time_column="BATCHNUMBER", tie_break=["TARGET"], **stamp,
        )
        nulls = quality.check_null(
            latest_batch(targets), "history.sales_target", key, key, **stamp
        )
        lake.quarantine("cur_fact_target", batch, nulls, duplicates)
        name = "curated.fact_target"
        fact = facts.fact_target(targets, run.run_ts)
        lake.replace(name, merge.replace_where_in(lake.ensure(name), fact, "YEAR"))
        return True

    return _job(lake, run, "cur_fact_target", ["hist_sales_target"], work)


def build_fact_session(lake: Lake, run: Run) -> bool:
    """Sessions of the newest batch: its dates of the fact are read, and of the stored sessions those
    that go on. Only the dates where these were or are now get rewritten."""

    def work(batch: int) -> bool:
        name, parts = "curated.fact_usersession_cal", list(writers.FACT_PARTITIONS)
        fact = lake.table("curated.fact_behaviour_log")
        newest = latest_batch(lake.table("history.behaviour_log")).select(*parts)
        spans = facts.session_spans(merge.touched_partitions(fact, newest, parts))
        sessions = facts.user_sessions(facts.continued_spans(spans, lake.ensure(name)), run.run_ts)
        sessions = sessions.select(*schemas.schema(name).names)
        merge.upsert_moving(lake.spark, lake.path(name), sessions, ["USER_SESSION"], schemas.PARTITIONING[name])
        return True

    return _job(lake, run, "cur_fact_session", ["cur_fact_behaviour"], work)


def analyse_rfm(lake: Lake, run: Run, rel_error: float | None = None) -> bool:
    def work(batch: int) -> bool:
        name = "curated.da_rfm_analysis"
        segments = rfm.rfm(lake.table("curated.fact_behaviour_log"), run.run_ts, rel_error)
        lake.replace(name, merge.upsert(lake.ensure(name), segments, ["USER_ID"], unique=True))
        return True

    return _job(lake, run, "da_rfm", ["cur_fact_behaviour"], work)


def update_rfm(lake: Lake, run: Run) -> bool:
    """The same table as ``analyse_rfm``, from stored totals: of the fact only the dates of the newest batch are read."""

    def work(batch: int) -> bool:
        parts = list(writers.FACT_PARTITIONS)
        newest = latest_batch(lake.table("history.behaviour_log")).select(*parts).distinct()
        events = merge.touched_partitions(lake.table("curated.fact_behaviour_log"), newest, parts)
        dates = newest.select(F.make_date(*parts).cast("string").alias("EVENT_DATE"))
        kept = segments.Segments(lake.spark, f"{lake.root}/state/rfm")
        kept.update(events, dates)
        name = "curated.da_rfm_analysis"
        lake.replace(name, merge.upsert(lake.ensure(name), kept.rfm(run.run_ts), ["USER_ID"], unique=True))
        return True

    return _job(lake, run, "da_rfm", ["cur_fact_behaviour"], work)


def predict_sales(
    lake: Lake,
    run: Run,
    products: weekly.Products = None,
    search: forecast.Search = forecast.Search(),
    **split,
) -> bool:
    def work(batch: int) -> bool:
        name = "curated.ml_sales_prediction"
        events = weekly.with_weeks(lake.table("curated.fact_behaviour_log"))
        table = stored(forecast.sales_prediction(events, products, search, **split), "predicted")
        lake.replace(name, merge.upsert(lake.ensure(name), table, [*weekly.WEEK, "PRODUCT_ID"]))
        return True

    return _job(lake, run, "ml_sales_prediction", ["cur_fact_behaviour"], work)


def write_summaries(
    lake: Lake, orchestrator: DataFrame, sources: dict[str, str], prefix: str = "cur_"
) -> None:
    """The log files of a batch: its ledger rows, its sources, the watermark per source."""
    ledger = lake.table(LEDGER)
    batch = lg.latest_batch_id(ledger, lg.START).first()["batchID"]
    reports = {
        "batch_summary": lg.batch_summary(ledger, batch),
        "source_summary": lg.batch_summary(lake.table(AUDIT), str(batch)),
        "success_summary": lg.success_watermark(ledger, orchestrator, sources, prefix),
    }
    for name, report in reports.items():
        writers.write_csv(report, f"{lake.root}/log/{batch}/{name}", single_file=True)
