"""Least squares per group from mergeable sums: no loop over groups, no Python worker."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketlens.functions.stats import two_sided_t


def fit_line(df: DataFrame, key: str, y: Column, x: Column) -> DataFrame:
    """Per key: slope, intercept, R2 and the two-sided p-value of the slope of y on x.

    NULL results when x or y does not vary or no degree of freedom is left.
    """
    sums = (
        df.select(key, y.alias("y"), x.alias("x"))
        .groupBy(key)
        .agg(
            F.regr_count("y", "x").alias("n"),
            F.regr_slope("y", "x").alias("slope"),
            F.regr_intercept("y", "x").alias("intercept"),
            F.regr_r2("y", "x").alias("r2"),
            F.regr_sxx("y", "x").alias("sxx"),
            F.regr_syy("y", "x").alias("syy"),
        )
    )
    fits = (F.col("n") > 2) & (F.col("sxx") > 0) & (F.col("syy") > 0)
    error = F.sqrt((1 - F.col("r2")) * F.col("syy") / (F.col("n") - 2) / F.col("sxx"))
    t = F.try_divide(F.col("slope"), error)
    return sums.select(
        key,
        F.col("n").alias("N"),
        *[F.when(fits, F.col(c)).alias(c.upper()) for c in ("slope", "intercept", "r2")],
        F.when(fits, two_sided_t(t, F.col("n") - 2)).alias("P_VALUE"),
    )


def _determinant(m: Sequence[Sequence[Column]]) -> Column:
    (a, b, c), (d, e, f), (g, h, i) = m
    return a * (e * i - f * h) - b * (d * i - f * g) + c * (d * h - e * g)


def fit_plane(
    df: DataFrame,
    key: str,
    y: Column,
    xs: Sequence[Column],
    *,
    charged_predictors: int = 3,
) -> DataFrame:
    """Per key: slope of the first of three predictors, R2 and its two-sided p-value.

    Solves the centred normal equations of the group's covariance matrix by Cramer's rule.
    ``charged_predictors`` is the number of predictors charged to the degrees of freedom
    of the t test; 3 is the statistically right value, 1 gives the looser n - 2 rule. NULL
    results when the predictors are collinear or y does not vary.
    """
    if len(xs) != 3:
        raise ValueError("three predictors expected")
    named = df.select(key, y.alias("y"), *[x.alias(f"x{i}") for i, x in enumerate(xs)]).na.drop()
    pairs = [(i, j) for i in range(3) for j in range(i, 3)]
    sums = named.groupBy(key).agg(
        F.count(F.lit(1)).alias("n"),
        F.var_pop("y").alias("yy"),
        *[F.covar_pop(f"x{i}", f"x{j}").alias(f"x{i}x{j}") for i, j in pairs],
        *[F.covar_pop(f"x{i}", "y").alias(f"x{i}y") for i in range(3)],
    )
    s = [[F.col(f"x{min(i, j)}x{max(i, j)}") for j in range(3)] for i in range(3)]
    r = [F.col(f"x{i}y") for i in range(3)]
    det = _determinant(s)

    def with_column(k: int) -> list[list[Column]]:
        return [[r[i] if j == k else s[i][j] for j in range(3)] for i in range(3)]

    solved = sums.withColumns(
        {
            "det": det,
            "scale": s[0][0] * s[1][1] * s[2][2],
            "minor": s[1][1] * s[2][2] - s[1][2] * s[1][2],
            **{f"d{k}": _determinant(with_column(k)) for k in range(3)},
        }
    )
    fits = (F.col("n") > 4) & (F.col("yy") > 0) & (F.col("det") > 1e-10 * F.col("scale"))
    beta = [F.try_divide(F.col(f"d{k}"), F.col("det")) for k in range(3)]
    explained = sum((b * c for b, c in zip(beta[1:], r[1:])), beta[0] * r[0])
    residual = F.greatest(F.lit(0.0), F.col("yy") - F.col("explained")) * F.col("n")
    # The variance of a slope always uses the model's own residual degrees of freedom.
    variance = F.try_divide(residual, F.col("n") - 4) * F.try_divide(
        F.col("minor"), F.col("det") * F.col("n")
    )
    t = F.try_divide(F.col("slope"), F.sqrt("variance"))
    p_value = two_sided_t(t, F.col("n") - 1 - charged_predictors)
    return (
        solved.withColumns({"slope": beta[0], "explained": explained})
        .withColumn("variance", variance)
        .select(
            key,
            F.col("n").alias("N"),
            F.when(fits, F.col("slope")).alias("SLOPE"),
            F.when(fits, F.try_divide(F.col("explained"), F.col("yy"))).alias("R2"),
            F.when(fits, p_value).alias("P_VALUE"),
        )
    )
