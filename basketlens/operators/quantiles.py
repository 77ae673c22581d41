"""Quantiles of many columns at once, exact or within a relative rank error."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def approx_quantiles(
    df: DataFrame, columns: Sequence[str], probabilities: Sequence[float], rel_error: float
) -> DataFrame:
    """One row, one array per column, each value within ``rel_error`` of its rank."""
    accuracy = max(1, round(1 / rel_error))
    return df.agg(
        *[
            F.percentile_approx(F.col(c).cast("double"), list(probabilities), accuracy).alias(c)
            for c in columns
        ]
    )


def quantile_rows(
    df: DataFrame,
    columns: Sequence[str],
    probabilities: Sequence[float],
    bracket: float = 1e-3,
) -> DataFrame:
    """(name, i, value): for each column and probability the smallest value covering that share of its rows.

    A mergeable sketch first gives, per column and probability, a value range that must
    contain the answer. A second pass counts what lies below the range and how often each
    value inside it occurs; only that slice (2 x ``bracket`` of the rows at most, apart
    from ties, which are one row) is ordered. No task sees a whole column.
    """
    probabilities = [float(p) for p in probabilities]
    ends = [b for p in probabilities for b in (max(0.0, p - bracket), min(1.0, p + bracket))]
    accuracy = int(4 / bracket)
    sketch = df.agg(
        *[
            F.struct(
                F.percentile_approx(F.col(c).cast("double"), ends, accuracy).alias("ends"),
                F.count(c).alias("n"),
            ).alias(c)
            for c in columns
        ]
    )
    # One row per column and probability: a size fixed by the arguments, so broadcast it.
    named = F.array(*[F.struct(F.lit(c).alias("name"), F.col(c)["ends"].alias("ends"), F.col(c)["n"].alias("n")) for c in columns])
    ranges = (
        sketch.select(F.explode(named).alias("column"))
        .select("column.*", F.posexplode(F.array(*map(F.lit, probabilities))).alias("i", "p"))
        .select(
            "name",
            "i",
            F.get("ends", 2 * F.col("i")).alias("low"),
            F.get("ends", 2 * F.col("i") + 1).alias("high"),
            F.ceil(F.col("p") * F.col("n")).alias("rank"),
        )
    )
    values = df.select(
        F.explode(
            F.array(
                *[
                    F.struct(F.lit(c).alias("name"), F.col(c).cast("double").alias("value"))
                    for c in columns
                ]
            )
        ).alias("cell")
    ).select("cell.*")
    counted = (
        values.join(F.broadcast(ranges), "name")
        .where("value <= high")
        .groupBy("name", "i", "rank", F.when(F.col("value") >= F.col("low"), F.col("value")).alias("value"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    upto = Window.partitionBy("name", "i").orderBy(F.col("value").asc_nulls_first())
    return (
        counted.withColumn("covered", F.sum("n").over(upto))
        .where("value is not null and covered >= rank")
        .groupBy("name", "i")
        .agg(F.min("value").alias("value"))
    )


def exact_quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probabilities: Sequence[float],
    bracket: float = 1e-3,
) -> DataFrame:
    """One row, one array per column: the values of ``quantile_rows``."""
    return quantile_rows(df, columns, probabilities, bracket).agg(
        *[
            F.array(
                *[
                    F.max(F.when((F.col("name") == c) & (F.col("i") == i), F.col("value")))
                    for i in range(len(probabilities))
                ]
            ).alias(c)
            for c in columns
        ]
    )
