"""Upsert and replace-by-key as DataFrame algebra, plus safe writes of the result."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Mapping, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from basketlens.session import passing, remove_path
from basketlens.sources.writers import laid_out, overwrite_path

# Given the target's and the source's columns by name, decides whether to update.
Condition = Callable[[Mapping[str, Column], Mapping[str, Column]], Column]


def require_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``df``, failing at run time if two rows share a key (NULL keys never match)."""
    complete = df.na.drop(subset=list(keys)) if keys else df
    most = complete.groupBy(*keys).count().agg(F.max("count")).scalar()
    refuse = F.raise_error(f"several source rows for one key {list(keys)}").cast("boolean")
    return df.where(F.when(most > 1, refuse).otherwise(F.lit(True)))


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    update_when: Condition | None = None,
    *,
    unique: bool = False,
) -> DataFrame:
    """Update matched rows, insert the others, keep the rest of the target.

    ``update_when(target, source)`` limits the update to matched rows that fulfil it. NULL
    keys never match, so such source rows are inserted. Target columns decide the layout.
    The check for two source rows with one key reads the source once more; ``unique`` says
    that its making rules that out, and the source is then planned only once.
    """
    keys = list(keys)
    source = source.select(*target.columns)
    if not unique:
        source = require_unique(source, keys)
    # One full join: a row is matched when both markers are set.
    t = {c: F.col(f"t.{c}") for c in [*target.columns, "__t"]}
    s = {c: F.col(f"s.{c}") for c in [*target.columns, "__s"]}
    joined = target.withColumn("__t", F.lit(True)).alias("t").join(
        source.withColumn("__s", F.lit(True)).alias("s"), [t[k] == s[k] for k in keys], "full"
    )
    update = F.lit(True) if update_when is None else update_when(t, s)
    take_source = t["__t"].isNull() | (s["__s"] & update)
    return joined.select(
        *[F.when(take_source, s[c]).otherwise(t[c]).alias(c) for c in target.columns]
    )


def occurs_in(df: DataFrame, source: DataFrame, columns: Sequence[str]) -> Column:
    """Whether a row of ``df`` has a combination of values that occurs in ``source``, NULLs equal.

    The combinations are a list in a scalar subquery, which Spark evaluates before it lists
    the files: on partition columns it prunes the scan. Only for columns with few values, such as
    dates; the list has one entry for each.
    """
    values = lambda: F.struct(*[F.col(c).cast(df.schema[c].dataType).alias(c) for c in columns])
    found = source.agg(F.collect_set(values()).alias("found")).scalar()
    return F.coalesce(F.array_contains(found, values()), F.lit(False))


def replace_where_in(target: DataFrame, source: DataFrame, column: str) -> DataFrame:
    """Drop target rows whose ``column`` value occurs in the source, then append it.

    The column must have few values, such as a year. The target is filtered as it is read, without
    a shuffle. Rows without a value are kept.
    """
    kept = F.col(column).isNull() | ~occurs_in(target, source, [column])
    return target.where(kept).unionByName(source.select(*target.columns))


@contextmanager
def _staged(df: DataFrame, path: str) -> Iterator[DataFrame]:
    """``df`` written next to ``path`` under a name of its own and read back, so the target is never
    read while it is being replaced. The copy stays if the replacement fails, which can then be
    repeated from it, and is removed otherwise."""
    stage = f"{path.rstrip('/')}__stage-{uuid.uuid4().hex}"
    df.write.option("partitionOverwriteMode", "static").parquet(stage)
    yield df.sparkSession.read.schema(df.schema).parquet(stage)
    remove_path(df.sparkSession, stage)


def rewrite_table(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Replace the whole table at ``path`` with ``df``, which may itself read that table."""
    with _staged(df, path) as staged:
        overwrite_path(staged, path, partition_by)


def rewrite_partitions(df: DataFrame, path: str, partition_by: Sequence[str]) -> None:
    """Replace the partitions that occur in ``df``; the others stay as they are."""
    with _staged(df, path) as staged:
        laid_out(staged, partition_by).write.mode("overwrite").option(
            "partitionOverwriteMode", "dynamic"
        ).partitionBy(*partition_by).parquet(path)


def touched_partitions(target: DataFrame, source: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """The rows of ``target`` in partitions that occur in ``source``; the scan is pruned to them."""
    return target.where(occurs_in(target, source, partition_by))


def upsert_partitions(
    spark: SparkSession,
    path: str,
    source: DataFrame,
    keys: Sequence[str],
    partition_by: Sequence[str],
    update_when: Condition | None = None,
    *,
    decided_by: Sequence[str],
    unique: bool = False,
) -> None:
    """Upsert into a table at ``path``, rewriting only the partitions the source touches.

    ``decided_by`` names the keys that determine the partition, such as an event's time its
    date, so that a row can never move; without such keys use ``rewrite_table(upsert(...))``. A
    source in which one value of them lies in two partitions is refused. The
    source is stored while this runs because the list of partitions and the merge both read it.
    """
    if not decided_by or not set(decided_by) <= set(keys):
        raise ValueError(f"decided_by must name some of the keys {list(keys)}")
    with passing(source, "upsert-source") as source:
        places = source.na.drop(subset=list(decided_by)).groupBy(*decided_by)
        parts = F.struct(*partition_by)
        moved = places.agg(F.min(parts).alias("low"), F.max(parts).alias("high")).where("low <> high")
        if not moved.isEmpty():
            raise ValueError(f"{list(decided_by)} do not determine the partition")
        target = spark.read.schema(source.schema).parquet(path)
        current = touched_partitions(target, source, partition_by)
        merged = upsert(current, source, keys, update_when, unique=unique)
        rewrite_partitions(merged, path, partition_by)


def upsert_moving(
    spark: SparkSession,
    path: str,
    source: DataFrame,
    keys: Sequence[str],
    partition_by: Sequence[str],
) -> None:
    """Upsert rows whose partition may change into a table at ``path``.

    Rewritten are the partitions that the source goes to and those that hold older rows of its
    keys; to find the latter only keys and partition columns of the table are read. A partition that
    is left without a row is removed by the name that Spark gives its folder. The source must have one row per key, and
    keys must not be NULL. A run that stops before the removal leaves older rows beside the new ones; to repeat it finishes it.
    """
    kinds = dict(source.dtypes)
    # an empty string is stored in the folder of NULL
    folder_values = [F.expr(f"nullif(`{c}`, '')").alias(c) if kinds[c] == "string" else F.col(c) for c in partition_by]
    with passing(source, "upsert-source") as source:
        target = spark.read.schema(source.schema).parquet(path)
        own = source.select(*keys)
        left = target.select(*keys, *partition_by).join(own, list(keys), "left_semi").select(*partition_by)
        with passing(source.select(*partition_by).union(left).select(*folder_values).distinct(), "touched") as touched:
            current = touched_partitions(target, touched, partition_by)
            merged = current.join(own, list(keys), "left_anti").select(*source.columns).unionByName(source)
            with _staged(merged, path) as staged:
                same = [F.col(f"t.{c}").eqNullSafe(F.col(f"s.{c}")) for c in partition_by]
                places = staged.select(*folder_values).distinct().alias("s")
                emptied = touched.alias("t").join(places, same, "left_anti")
                emptied = emptied.select(*(F.col(c).cast("string").alias(c) for c in partition_by)).collect()  # a few folders
                laid_out(staged, partition_by).write.mode("overwrite").option(
                    "partitionOverwriteMode", "dynamic"
                ).partitionBy(*partition_by).parquet(path)
            for row in emptied:
                remove_path(spark, "/".join([path.rstrip("/"), *(partition_folder(spark, c, row[c]) for c in partition_by)]))


def partition_folder(spark: SparkSession, column: str, value: str | None) -> str:
    """The name of a partition's folder as Spark writes it: NULL has its own, special characters are escaped."""
    return spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.getPartitionPathString(column, value)
