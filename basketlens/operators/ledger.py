"""Questions about the run ledger: batch ids, gates, completion and watermarks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from basketlens.operators.ordering import as_of

START = "Start"
RUNNING, COMPLETE = "running", "complete"


def _latest(item: str | Column) -> Column:
    batch = F.when(F.col("item") == item, F.col("batchID"))
    return F.coalesce(F.max(batch), F.lit(0))


def latest_batch_id(ledger: DataFrame, item: str) -> DataFrame:
    """The highest batch of an item, 0 if it never ran."""
    return ledger.agg(_latest(item).alias("batchID"))


def _next(own: Column, started: Column) -> Column:
    return F.when(own >= started, own + 1).otherwise(started)


def next_batch_id(ledger: DataFrame, item: str) -> DataFrame:
    """The batch an item's next run belongs to.

    An item that is behind the last opened batch joins it, otherwise it goes one further;
    an empty ledger gives 1.
    """
    return ledger.agg(_next(_latest(item), _latest(START)).alias("batchID"))


def next_batch_ids(ledger: DataFrame) -> DataFrame:
    """``next_batch_id`` of every item in the ledger."""
    started = ledger.agg(_latest(START)).scalar()
    own = ledger.groupBy("item").agg(F.max("batchID").alias("own"))
    return own.select("item", _next(F.col("own"), started).alias("batchID"))


def open_row(
    spark: SparkSession, batch: int, date: str, start_time: str, item: str
) -> DataFrame:
    """The ledger row of a run that has just started."""
    return spark.createDataFrame(
        [(batch, date, start_time, item, RUNNING)],
        "batchID INT, date STRING, startTime STRING, item STRING, status STRING",
    )


def complete_batch(ledger: DataFrame, item: str | Column, batch: int | Column) -> DataFrame:
    """The ledger with the item's run in that batch marked complete."""
    run = (F.col("item") == item) & (F.col("batchID") == batch)
    return ledger.withColumn("status", F.when(run, COMPLETE).otherwise(F.col("status")))


def latest_status(ledger: DataFrame) -> DataFrame:
    """Batch and status of the latest run of every item."""
    last = F.max(F.struct("batchID", "startTime", "status")).alias("last")
    return ledger.groupBy("item").agg(last).select("item", "last.batchID", "last.status")


def gate(ledger: DataFrame, items: Sequence[str]) -> DataFrame:
    """One row: is the latest run of every listed item complete? Exact item names."""
    done = latest_status(ledger.where(F.col("item").isin(list(items)))).where(
        F.col("status") == COMPLETE
    )
    return done.agg((F.count(F.lit(1)) == len(set(items))).alias("passed"))


def close_batch(ledger: DataFrame) -> DataFrame:
    """Mark the last opened batch complete unless one of its items is still running."""
    current = ledger.where(F.col("item") == START).agg(F.max("batchID")).scalar()
    running = (
        (F.col("batchID") == current)
        & (F.col("item") != START)
        & (F.col("status") == RUNNING)
    )
    still_running = ledger.agg(F.count_if(running)).scalar()
    closes = (F.col("item") == START) & (F.col("batchID") == current) & (still_running == 0)
    return ledger.withColumn("status", F.when(closes, COMPLETE).otherwise(F.col("status")))


def has_new_data(history: DataFrame, batch: int | Column) -> DataFrame:
    """One row: does the history hold data of this batch (or a later one)?"""
    newest = F.coalesce(F.max("BATCHNUMBER"), F.lit(0))
    return history.agg((newest >= batch).alias("has_new_data"))


def success_watermark(
    ledger: DataFrame, orchestrator: DataFrame, sources: Mapping[str, str], prefix: str
) -> DataFrame:
    """Per source: up to when its data has been processed, and in which batch.

    Looks at the latest complete run of each item whose name starts with ``prefix``; a
    source is as far as its slowest item. The watermark is the end of the source's last
    complete copy job if the runs started after it, else the start of the runs, as
    ``yyyy-MM-ddTHH:mm:ss.00Z``. The item-to-source map is an argument of a few entries
    and becomes a constant in the plan.
    """
    pairs = [F.lit(text) for pair in sources.items() for text in pair]
    copied = (
        orchestrator.where(F.col("status") == COMPLETE)
        .groupBy(F.col("item").alias("source"))
        .agg(F.max("endTime").alias("endTime"))
    )
    runs = (
        ledger.where((F.col("status") == COMPLETE) & F.col("item").startswith(prefix))
        .groupBy("item")
        .agg(F.max("startTime").alias("startTime"), F.max("batchID").alias("batchID"))
        .withColumn("source", F.element_at(F.create_map(*pairs), F.col("item")))
        .where(F.col("source").isNotNull())
        .groupBy("source")
        .agg(F.min("startTime").alias("startTime"), F.min("batchID").alias("batchID"))
    )
    ended = F.coalesce(
        F.when(F.col("startTime") >= F.col("endTime"), F.col("endTime")), F.col("startTime")
    )
    stamp = F.concat(F.substring(F.regexp_replace(ended, " ", "T"), 1, 19), F.lit(".00Z"))
    return runs.join(copied, "source", "left").select(
        "source", stamp.alias("endTime"), "batchID"
    )


def runs_with_copy(ledger: DataFrame, orchestrator: DataFrame, sources: Mapping[str, str]) -> DataFrame:
    """Every complete run of an item with a source, and the end of the source's last complete copy job before it started
    (NULL if there was none): what data each run has worked on, not only the last one."""
    pairs = [F.lit(text) for pair in sources.items() for text in pair]
    runs = ledger.where(F.col("status") == COMPLETE).withColumn(
        "source", F.element_at(F.create_map(*pairs), F.col("item"))
    )
    runs = runs.where(F.col("source").isNotNull()).select("item", "batchID", "startTime", "source")
    copies = orchestrator.where(F.col("status") == COMPLETE).select(F.col("item").alias("source"), "endTime")
    month = lambda time: F.substring(time, 1, 7)
    return as_of(runs, copies, ["source"], "startTime", "endTime", ["endTime"], cut=month)


def batch_summary(log: DataFrame, batch: int | str) -> DataFrame:
    """Rows of one batch of the ledger or of the source audit, by start time."""
    return log.where(F.col("batchID") == batch).orderBy("startTime")
