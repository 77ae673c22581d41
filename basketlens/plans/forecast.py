"""Sales forecast: three tree ensembles tuned by random search, on Spark ML or grown together (``operators.boosting``)."""

from __future__ import annotations

import math
import random
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from multiprocessing.pool import ThreadPool

from pyspark.ml import Estimator, Model
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.ml.tuning import CrossValidator
from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketlens.operators.boosting import Boosting, Ensemble, Fit, Setting
from basketlens.plans.weekly import (
    CELL,
    FEATURES,
    WEEK,
    Products,
    elasticity_controlled,
    log_counts,
    raw_features,
    time_split,
    weekly_demand,
)
from basketlens.session import stored

LABEL = "SALES_OCCURRENCE"

# The searched settings of the three models, under Spark's parameter names.
SPACE_XG = {
    "maxIter": [500, 1000, 1500, 2000],
    "stepSize": [0.005, 0.01, 0.05, 0.1],
    "maxDepth": [3, 6, 8, 10],
    "minInstancesPerNode": [1, 3, 5],
    "subsamplingRate": [0.6, 0.8, 1.0],
    "featureSubsetStrategy": ["0.6", "0.8", "1.0"],
    "minInfoGain": [0.0, 0.1, 0.3],
}
SPACE_GB = {
    "maxIter": [500, 1000, 1500, 2000],
    "stepSize": [0.005, 0.01, 0.05, 0.1],
    "maxDepth": [3, 6, 8, 10],
    "minInstancesPerNode": [1, 2, 5],
    "subsamplingRate": [0.6, 0.8, 1.0],
    "featureSubsetStrategy": ["sqrt", "log2", "all"],
}
SPACE_RF = {
    "numTrees": [100, 300, 500, 1000],
    "maxDepth": [5, 10, 15, 20],
    "minInstancesPerNode": [1, 2, 4],
    "featureSubsetStrategy": ["all", "sqrt", "0.5"],
    "bootstrap": [True, False],
}
SPACES = {"XG": SPACE_XG, "GB": SPACE_GB, "RF": SPACE_RF}

# The spaces of the two boosted models in full, under the names of ``operators.boosting``.
GROWN_XG = {
    "rounds": [500, 1000, 1500, 2000],
    "rate": [0.005, 0.01, 0.05, 0.1],
    "depth": [3, 6, 8, 10],
    "child_rows": [1, 3, 5],
    "rows": [0.6, 0.8, 1.0],
    "columns": [0.6, 0.8, 1.0],
    "least_gain": [0.0, 0.1, 0.3],
    "penalty": [0.0, 1.0, 10.0],
}
GROWN_GB = {
    "rounds": [500, 1000, 1500, 2000],
    "rate": [0.005, 0.01, 0.05, 0.1],
    "depth": [3, 6, 8, 10],
    "split_rows": [2, 5, 10],
    "rows": [0.6, 0.8, 1.0],
    "columns": [int(math.sqrt(len(FEATURES))) / len(FEATURES), int(math.log2(len(FEATURES))) / len(FEATURES), 1.0],
}
GROWN = {"XG": (GROWN_XG, {}), "GB": (GROWN_GB, {"by_node": True, "penalty": 0.0})}

# One setting out of each space, for a fit without a search.
FIXED = {
    "XG": {
        "maxIter": 500, "stepSize": 0.1, "maxDepth": 3, "minInstancesPerNode": 1,
        "subsamplingRate": 1.0, "featureSubsetStrategy": "1.0", "minInfoGain": 0.0,
    },
    "GB": {
        "maxIter": 500, "stepSize": 0.1, "maxDepth": 3, "minInstancesPerNode": 1,
        "subsamplingRate": 1.0, "featureSubsetStrategy": "all",
    },
    "RF": {
        "numTrees": 100, "maxDepth": 5, "minInstancesPerNode": 1, "featureSubsetStrategy": "all",
        "bootstrap": True,
    },
}


@dataclass(frozen=True)
class Search:
    """Budget and spaces of a random search, by model."""

    draws: int = 20
    folds: int = 5
    seed: int = 42
    parallelism: int = 4
    spaces: Mapping[str, Mapping[str, Sequence]] = field(default_factory=lambda: SPACES)


def with_vectors(features: DataFrame) -> DataFrame:
    """Assemble the features; NULL becomes 0 next to a marker column, which trees can use."""
    markers = [f"{c}__missing" for c in FEATURES]
    complete = features.withColumns(
        {
            **{m: F.col(c).isNull().cast("double") for c, m in zip(FEATURES, markers)},
            **{c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in FEATURES},
        }
    )
    assembler = VectorAssembler(inputCols=[*FEATURES, *markers], outputCol="features")
    return assembler.transform(complete).drop(*markers)


def _draws(estimator: Estimator, space: Mapping[str, Sequence], search: Search) -> list[dict]:
    return [{estimator.getParam(k): v for k, v in s.items()} for s in _drawn(space, search)]


def _drawn(space: Mapping[str, Sequence], search: Search) -> list[dict]:
    # Combinations are numbered, so that drawing distinct numbers draws without replacement.
    combinations = math.prod(len(values) for values in space.values())
    numbers = random.Random(search.seed).sample(
        range(combinations), min(search.draws, combinations)
    )
    drawn = []
    for number in numbers:
        settings = {}
        for name, values in space.items():
            number, choice = divmod(number, len(values))
            settings[name] = values[choice]
        drawn.append(settings)
    return drawn


def _rmse(label: str = LABEL, prediction: str = "prediction") -> RegressionEvaluator:
    return RegressionEvaluator(labelCol=label, predictionCol=prediction, metricName="rmse")


def _bucket(buckets: int, seed: int):
    """A repeatable bucket number from the row's key, unaffected by task order."""
    return F.pmod(F.xxhash64(*CELL, F.lit(seed)), F.lit(buckets)).cast("int")


def boosted_a(search: Search) -> Estimator:
    """Boosted trees that stop when a fifth of the training rows, held out, no longer gain.

    There is no waiting for a number of rounds: it stops at the first step without a gain
    worth mentioning, hence the small tolerance.
    """
    return GBTRegressor(
        labelCol=LABEL, seed=search.seed, validationIndicatorCol="__holdout", validationTol=1e-5
    )


def boosted_b(search: Search) -> Estimator:
    return GBTRegressor(labelCol=LABEL, seed=search.seed)


def forest(search: Search) -> Estimator:
    return RandomForestRegressor(labelCol=LABEL, seed=search.seed)


ESTIMATORS: dict[str, Callable[[Search], Estimator]] = {"XG": boosted_a, "GB": boosted_b, "RF": forest}


def _marked(train: DataFrame, search: Search) -> DataFrame:
    return train.withColumns(
        {
            "__holdout": _bucket(5, search.seed + 1) == 0,
            "__fold": _bucket(search.folds, search.seed),
        }
    )


def fit_fixed(name: str, train: DataFrame, settings: Mapping, search: Search = Search()) -> Model:
    """One fit with explicit settings."""
    model = ESTIMATORS[name](search)
    return model.fit(_marked(train, search), {model.getParam(k): v for k, v in settings.items()})


def fit_crossed(name: str, train: DataFrame, search: Search = Search()) -> Model:
    """The best of the drawn settings by k-fold cross-validation."""
    model = ESTIMATORS[name](search)
    cv = CrossValidator(
        estimator=model,
        estimatorParamMaps=_draws(model, search.spaces[name], search),
        evaluator=_rmse(),
        numFolds=search.folds,
        foldCol="__fold",
        parallelism=search.parallelism,
    )
    return cv.fit(_marked(train, search)).bestModel


def fit_expanding(name: str, train: DataFrame, search: Search = Search()) -> Model:
    """The best of the drawn settings on an expanding window.

    The training weeks are cut into ``folds`` + 1 stretches in time order; every draw is
    fitted on the stretches so far and judged on the next, ``parallelism`` fits at a time. Only the list
    of distinct weeks, which the calendar bounds, is read to cut them.
    """
    model = ESTIMATORS[name](search)
    weeks = [tuple(r) for r in train.select(*WEEK).distinct().orderBy(*WEEK).collect()]
    draws = _draws(model, search.spaces[name], search)
    if len(weeks) <= search.folds:
        raise ValueError(f"{search.folds} folds need more than {len(weeks)} training weeks")
    size = len(weeks) // (search.folds + 1)
    starts = [weeks[len(weeks) - size * (search.folds - i)] for i in range(search.folds)]

    def at(week: tuple) -> Column:
        return F.struct(*[F.lit(n).alias(c) for n, c in zip(week, WEEK)])

    here = F.struct(*WEEK)

    def error(task: tuple[int, int]) -> float:
        i, j = task
        ahead = train.where(here >= at(starts[i]))
        if i + 1 < len(starts):
            ahead = ahead.where(here < at(starts[i + 1]))
        return _rmse().evaluate(model.fit(train.where(here < at(starts[i])), draws[j]).transform(ahead))

    tasks = [(i, j) for i in range(len(starts)) for j in range(len(draws))]
    with ThreadPool(search.parallelism) as pool:
        errors = pool.map(inheritable_thread_target(train.sparkSession)(error), tasks, chunksize=1)
    scores = [sum(e for (_, k), e in zip(tasks, errors) if k == j) for j in range(len(draws))]
    return model.fit(train, draws[scores.index(min(scores))])


def grown_settings(name: str, search: Search = Search()) -> list[Setting]:
    """The drawn settings of a boosted model; ``search.spaces`` may narrow the values of a name."""
    space, always = GROWN[name]
    narrowed = {k: v for k, v in search.spaces.get(name, {}).items() if k in space}
    return [Setting(**always, **s) for s in _drawn(space | narrowed, search)]


def _hex(salt: str) -> Column:
    """32 bits of a row's key, the same in every engine."""
    text = F.concat_ws("|", F.lit(salt), *[F.col(c).cast("string") for c in CELL])
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("long")


def stretches(train: DataFrame, folds: int) -> Column:
    """0 for the first training weeks, then 1 to ``folds`` in time order.

    The last ``folds`` stretches are equally many weeks long, the first takes the rest. Only the list of distinct weeks, which
    the calendar bounds, is read.
    """
    weeks = [tuple(r) for r in train.select(*WEEK).distinct().orderBy(*WEEK).collect()]
    if len(weeks) <= folds:
        raise ValueError(f"{folds} folds need more than {len(weeks)} training weeks")
    size = len(weeks) // (folds + 1)
    found = F.lit(0)
    for i in range(folds):
        start = F.struct(*[F.lit(n).alias(c) for n, c in zip(weeks[len(weeks) - size * (folds - i)], WEEK)])
        found = found + (F.struct(*WEEK) >= start).cast("int")
    return found


def dealt(train: DataFrame, search: Search = Search(), *, expanding: bool = False) -> DataFrame:
    """Training rows with fold, holdout and key for ``Boosting``.

    Crossed folds and the holdout, a fifth, are dealt by the row's key. An expanding search has no holdout: its
    model knows no early stop.
    """
    fold = stretches(train, search.folds) if expanding else (_hex(f"fold{search.seed}") % search.folds).cast("int")
    holdout = F.lit(False) if expanding else _hex(f"holdout{search.seed}") % 5 == 0
    return train.withColumns({"fold": fold, "holdout": holdout, "key": _hex("key")})


def grown_search(
    name: str, train: DataFrame, search: Search = Search(), *, bins: int = 32, patience: int = 50
) -> tuple[list[Fit], Callable[[], Ensemble]]:
    """All draws on all folds, grown together, and a function that grows the best draw on all training rows.

    ``train`` are log counts with missing values left missing. XG is crossed and stops by its holdout, GB goes by
    expanding stretches; a draw's score is the mean error over its folds.
    """
    expanding = MODELS[name] is fit_expanding
    boosting = Boosting(dealt(train, search, expanding=expanding), FEATURES, LABEL, bins=bins, seed=search.seed)
    settings, folds = grown_settings(name, search), range(search.folds)
    fits = boosting.grow(settings, folds, expanding=expanding, patience=patience)

    def best() -> Ensemble:
        scores = [sum(f.error() for f in fits if f.setting is s) for s in settings]
        (fit,) = boosting.grow([settings[scores.index(min(scores))]], [None], patience=patience)
        return boosting.ensemble(fit)

    return fits, best


MODELS: dict[str, Callable[[str, DataFrame, Search], Model]] = {
    "XG": fit_crossed,
    "GB": fit_expanding,
    "RF": fit_crossed,
}


def predict(model: Model, rows: DataFrame, out: str) -> DataFrame:
    """Add ``out`` (sales, cut to whole numbers) and ``out__log``; keys stay on the row."""
    scored = model.transform(rows).withColumnRenamed("prediction", f"{out}__log")
    return scored.withColumn(out, F.exp(f"{out}__log").cast("long"))


def forecast(
    features: DataFrame,
    models: Sequence[str] = ("XG", "GB", "RF"),
    search: Search = Search(),
    *,
    fixed: Mapping[str, Mapping] | None = None,
    train_weeks: Sequence[int] | None = (4, 3, 2, 1),
    last_n: int | None = None,
) -> DataFrame:
    """Predictions of the test week. ``features`` are raw counts (``raw_features``).

    With ``fixed``, settings by model, each model is fitted once and nothing is searched.

    The weekly rows, one per product and week, are stored for the many fits of the search,
    so that neither a fit nor a lost executor goes back to the events.
    """
    split = time_split(features, train_weeks, last_n).withColumn("ACTUAL_SALES", F.col(LABEL))
    rows = stored(with_vectors(log_counts(split)), "vectors")
    # A few rows per product: one task for every 100,000 of them serves the many passes best.
    train = rows.where("SPLIT = 'train'")
    train = train.coalesce(max(1, math.ceil(train.count() / 100_000)))
    scored = rows.where("SPLIT = 'test'")
    for name in models:
        model = fit_fixed(name, train, fixed[name], search) if fixed else MODELS[name](name, train, search)
        scored = predict(model, scored, f"SALES_PREDICTION_{name}")
    return scored


def as_full_weeks(scored: DataFrame, days: DataFrame) -> DataFrame:
    """Log sales of weeks that are seen only in part, scaled to seven days as ``weekly_sales`` does.

    Forecasts are of whole weeks. On a week of two days all of them are off by ln 3.5, and the smallest error is then that of
    the lowest forecast. ``days`` are ``days_seen`` of the events.
    """
    seen = scored.join(days, WEEK, "left")
    return seen.withColumn(LABEL, F.col(LABEL) + F.ln(7 / F.col("DAYS_SEEN"))).drop("DAYS_SEEN")


def holdout_rmse(scored: DataFrame, models: Sequence[str] = ("XG", "GB", "RF")) -> DataFrame:
    """Root mean squared error of each model on the log scale, one row per model."""
    errors = [
        F.struct(
            F.lit(name).alias("MODEL"),
            F.sqrt(F.avg(F.pow(F.col(LABEL) - F.col(f"SALES_PREDICTION_{name}__log"), 2))).alias(
                "RMSE"
            ),
        )
        for name in models
    ]
    return scored.agg(F.explode(F.array(*errors)).alias("e")).select("e.*")


OUTPUT = [
    *WEEK, "PRODUCT_ID", "MEAN_PRICE", "ACTUAL_SALES", "SALES_PREDICTION_XG",
    "SALES_PREDICTION_GB", "SALES_PREDICTION_RF", "ELASTICITY", "LR_R2_SCORE",
    "COEFFICIENT_PVALUE",
]


def prediction_table(features: DataFrame, scored: DataFrame, elasticity: DataFrame) -> DataFrame:
    """Past sales and the predicted week in one table.

    The predicted week carries prediction and elasticity instead of its plain history row;
    what history cannot know is NULL.
    """
    known = elasticity.select(
        "PRODUCT_ID",
        "ELASTICITY",
        F.col("R2_SCORE").alias("LR_R2_SCORE"),
        "COEFFICIENT_PVALUE",
    )
    missing = [c for c in OUTPUT if c.startswith("SALES_PREDICTION") and c not in scored.columns]
    scored = scored.withColumns({c: F.lit(None).cast("long") for c in missing})
    predicted = scored.join(known, "PRODUCT_ID", "left").select(*OUTPUT)
    last = features.agg(F.max(F.struct(*WEEK))).scalar()
    past = features.where(F.struct(*WEEK) < last).select(
        *WEEK, "PRODUCT_ID", "MEAN_PRICE", F.col(LABEL).alias("ACTUAL_SALES")
    )
    table = past.unionByName(predicted, allowMissingColumns=True)
    types = {"WEEK_NUMBER_CYCLE": "long", "WEEK_NUMBER": "long"}
    return table.select(*[F.col(c).cast(types[c]) if c in types else F.col(c) for c in OUTPUT])


def in_order(table: DataFrame) -> DataFrame:
    """The prediction table as it is presented: by cycle, week and product."""
    return table.orderBy(*WEEK, "PRODUCT_ID")


def sales_prediction(
    events: DataFrame,
    products: Products = None,
    search: Search = Search(),
    **split,
) -> DataFrame:
    """Features, elasticity, three forecasts and the resulting table, from weekly events."""
    features = stored(raw_features(events, products), "features")
    scored = forecast(features, search=search, **split)
    elasticity = elasticity_controlled(weekly_demand(events), products)
    return prediction_table(features, scored, elasticity)
