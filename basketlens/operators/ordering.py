"""Latest batch, deterministic dedupe and row numbering that survives hot keys."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_batch(df: DataFrame, column: str = "BATCHNUMBER") -> DataFrame:
    """Rows of the highest batch number.

    The maximum is a scalar subquery, so on a table partitioned by batch it prunes
    partitions at run time and nothing is collected.
    """
    return df.where(F.col(column) == df.agg(F.max(column)).scalar())


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key, the first in ``order`` (NULL keys count as equal).

    Spark limits each key to one row before the shuffle, so a key that holds a large
    share of the table still sends one row per input task.
    """
    first = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("__rank", first).where("__rank = 1").drop("__rank")


def keep_latest(
    df: DataFrame, keys: Sequence[str], time_column: str, tie_break: Sequence[str]
) -> DataFrame:
    """Latest row per key; equal times are settled by ``tie_break`` ascending."""
    order = [F.col(time_column).desc_nulls_last(), *[F.col(c).asc_nulls_last() for c in tie_break]]
    return keep_first(df, keys, order)


def running_total(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    weight: str,
    out: str,
    *,
    levels: Sequence[Mapping[str, Column]],
    starts: DataFrame | None = None,
) -> DataFrame:
    """Running sum of ``weight`` within ``keys`` following the columns ``order`` (ascending, NULLs last).

    Every key is cut the same way, whatever its size. ``levels`` are cuts of the order from
    coarse to fine, each a set of named columns by which the rows of the level above are
    ordered and grouped. Rows are summed up within their finest group alone; the totals of the
    groups before it are added level by level, from tables that are partial aggregates of
    the rows. So the largest window group is the largest number of parts of one group, not the largest key.
    Keys must not be NULL. A level's columns are one struct, which never is NULL and equals another one
    with the same NULLs: windows, sums and joins hash the same columns, and the rows are shuffled once.
    ``starts`` (one row per key: the keys and ``start``) says from where a key's sum goes on, 0 if it has no row there; it
    meets the totals of the coarsest level, never the rows.
    """
    cut = df.withColumns({name: column for level in levels for name, column in level.items()})
    cut = cut.withColumns({f"__level{i}": F.struct(*level) for i, level in enumerate(levels)})
    groups = [[*keys, *(f"__level{k}" for k in range(i))] for i in range(len(levels) + 1)]
    finest = Window.partitionBy(*groups[-1]).orderBy(*[F.col(c).asc_nulls_last() for c in order])
    inside = F.sum(weight).over(finest.rowsBetween(Window.unboundedPreceding, 0))
    offsets = None
    totals = cut.groupBy(*groups[-1]).agg(F.sum(weight).alias("__total"))
    for (i, level), (upper, group) in reversed(list(zip(enumerate(levels), zip(groups, groups[1:])))):
        parts = totals if group == groups[-1] else totals.groupBy(*group).agg(F.sum("__total").alias("__total"))
        walk = Window.partitionBy(*upper).orderBy(*[F.col(f"__level{i}.{c}").asc_nulls_last() for c in level])
        before = F.coalesce(F.sum("__total").over(walk.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        own = parts.select(*group, before.alias("__before"))
        if not i and starts is not None:
            begun = starts.select(*keys, F.col("start").alias("__start"))
            own = own.join(begun, list(keys), "left").withColumn("__before", F.col("__before") + F.coalesce("__start", F.lit(0)))
            own = own.drop("__start")
        if offsets is None:
            offsets = own
        else:
            coarser = own.withColumnRenamed("__before", "__more")
            offsets = offsets.join(coarser, group).withColumn("__before", F.col("__before") + F.col("__more")).drop("__more")
    numbered = cut.withColumn("__inside", inside).join(offsets, groups[-1])
    made = [name for level in levels for name in level if name not in df.columns]
    return numbered.withColumn(out, F.col("__inside") + F.col("__before")).drop("__inside", "__before", *groups[-1][len(keys) :], *made)


def repeat_rows(
    df: DataFrame, copies: str, last: str, out: str, *, keys: Sequence[str], block: int = 100_000
) -> DataFrame:
    """Each row ``copies`` times, numbered up to ``last`` in ``out``.

    Rows standing for more than ``block`` copies are first cut into blocks that are spread
    over the cluster, so neither one array nor one task holds all copies of a hot row. Only
    those blocks are shuffled; all other rows are written out where they are, and a grouping
    that follows still gets to pre-aggregate them before its own shuffle.
    """
    first = F.col(last) - F.col(copies) + 1
    plain = df.where(F.col(copies) <= block).withColumn(out, F.explode(F.sequence(first, last)))
    blocks = (
        df.where(F.col(copies) > block)
        .withColumn("__from", F.explode(F.sequence(first, F.col(last), F.lit(block).cast("long"))))
        .repartition(*keys, "__from")
    )
    heavy = blocks.withColumn(
        out,
        F.explode(F.sequence("__from", F.least(F.col("__from") + block - 1, F.col(last)))),
    ).drop("__from")
    return plain.unionByName(heavy).drop(copies, last)


def as_of(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    left_time: str,
    right_time: str,
    values: Sequence[str],
    *,
    cut: Callable[[Column], Column],
) -> DataFrame:
    """Every row of ``left`` with the ``values`` of the last row of ``right`` of its keys that is not later.

    Both sides are put into one table and the last value is carried forward, so no row meets more than one
    other. ``cut`` maps a time to a coarser one that never falls, such as its day: values are carried within
    the parts of a key, and from part to part by one row each, so a key with many rows is spread over its parts.
    Of several right rows at one time the one with the greatest values counts. Left rows without a time or
    with none before them get NULLs; NULL keys are equal. Right rows without a time are ignored.
    Column names of ``values`` must not occur in ``left``.
    """
    name = lambda c: f"__l_{c}"
    key = F.struct(*[F.col(c).alias(f"k{i}") for i, c in enumerate(keys)]).alias("__key")
    row, last = F.struct(*[F.col(c).alias(name(c)) for c in left.columns]), F.struct(F.col(right_time).alias("at"), *values)
    lefts = left.select(key, F.col(left_time).alias("__at"), row.alias("__row"))
    rights = right.where(F.col(right_time).isNotNull()).select(key, F.col(right_time).alias("__at"), last.alias("__last"))
    both = lefts.unionByName(rights, allowMissingColumns=True).withColumn("__part", F.struct(cut(F.col("__at")).alias("p")))
    # at one time the right rows come first
    order = Window.partitionBy("__key", "__part").orderBy("__at", F.col("__row").isNotNull().cast("int"), "__last")
    inside = F.last("__last", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    parts = both.groupBy("__key", "__part").agg(F.max("__last").alias("__newest"))
    earlier = Window.partitionBy("__key").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("__before", F.last("__newest", ignorenulls=True).over(earlier)).drop("__newest")
    found = both.withColumn("__inside", inside).where("__row is not null").join(parts, ["__key", "__part"])
    match = F.when(F.col("__at").isNotNull(), F.coalesce("__inside", "__before"))
    return found.withColumn("__match", match).select(
        *[F.col("__row")[name(c)].alias(c) for c in left.columns], *[F.col("__match")[v].alias(v) for v in values]
    )
