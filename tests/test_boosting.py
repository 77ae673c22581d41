"""Boosted trees against plain ones grown row by row."""

import math
import random

import pytest
from pyspark.sql import functions as F

from basketlens.operators.boosting import Boosting, Setting, binned, hashed
from basketlens.plans import forecast

SCALE = 1 << 20
NAMES = ["a", "b", "c"]


def data(n, seed=1):
    draw = random.Random(seed)
    rows = []
    for i in range(n):
        a, b = draw.choice([None, *range(9)]), draw.choice([0.5, 1.5, None, math.nan, 7.0])
        y = (a or 4) * 0.5 + (2.0 if b == 7.0 else 0.0) + draw.random()
        rows.append((a if a is None else float(a), b, draw.random(), y, i % 4, i % 5 == 0, i * 7919))
    return rows


@pytest.fixture(scope="module")
def boosting(spark):
    rows = spark.createDataFrame(data(240), "a double, b double, c double, y double, fold int, holdout boolean, key long")
    return Boosting(rows.repartition(5), NAMES, "y", bins=8)


def gone(x):
    return x is None or math.isnan(x)


def plain(rows, setting, cuts):
    """Trees row by row, over (features, margin, label): predictions of every row."""

    def value(part):
        g = sum(round((m - y) * SCALE) for _, m, y in part) / SCALE
        return -g / (len(part) + setting.penalty)

    def score(part):
        g = sum(round((m - y) * SCALE) for _, m, y in part) / SCALE
        return g * g / (len(part) + setting.penalty)

    def grow(part, depth):
        best = None
        if depth and len(part) >= setting.split_rows:
            for j in range(len(NAMES)):
                for cut in [-math.inf, *cuts[j]]:
                    for missing in (True, False):
                        left = [r for r in part if (missing if gone(r[0][j]) else r[0][j] <= cut)]
                        right = [r for r in part if not (missing if gone(r[0][j]) else r[0][j] <= cut)]
                        if min(len(left), len(right)) < max(1, setting.child_rows):
                            continue
                        gain = 0.5 * (score(left) + score(right) - score(part)) - setting.least_gain
                        if gain > 0 and (best is None or gain > best[0]):
                            best = gain, j, cut, missing, left, right
        if best is None:
            found = value(part)
            return lambda x: found
        _, j, cut, missing, left, right = best
        low, high = grow(left, depth - 1), grow(right, depth - 1)
        return lambda x: (low if (missing if gone(x[j]) else x[j] <= cut) else high)(x)

    return grow(rows, setting.depth)


@pytest.mark.parametrize("expanding", [False, True])
def test_fits_grown_together_equal_plain_trees(boosting, expanding):
    settings = [
        Setting(rounds=3, rate=0.5, depth=3),
        Setting(rounds=2, rate=0.3, depth=2, penalty=0.0, child_rows=6, split_rows=30),
        Setting(rounds=3, rate=0.1, depth=4, penalty=10.0, least_gain=0.3),
    ]
    fits = boosting.grow(settings, [0, 1, None], expanding=expanding, kept=2)
    assert len(fits) == 9
    for f in fits:
        rows = data(240)
        used = lambda fold: f.fold is None or (fold <= f.fold if expanding else fold != f.fold)  # noqa: E731, B023
        train = [r for r in rows if not r[5] and used(r[4])]
        base = sum(round(r[3] * SCALE) for r in train) / SCALE / len(train)
        margins = {r[6]: base for r in rows}
        held = [r for r in rows if r[5] and used(r[4])]
        judged = [r for r in rows if not r[5] and f.fold is not None and r[4] == (f.fold + 1 if expanding else f.fold)]
        for turn in range(f.setting.rounds + 1):
            for part, errors in ((held, f.held), (judged, f.judged)):
                if part:
                    error = math.sqrt(sum((margins[r[6]] - r[3]) ** 2 for r in part) / len(part))
                    assert errors[turn] == pytest.approx(error, abs=1e-6)
            if turn < f.setting.rounds:
                tree = plain([(r[:3], margins[r[6]], r[3]) for r in train], f.setting, boosting.cuts)
                margins = {r[6]: margins[r[6]] + f.setting.rate * tree(r[:3]) for r in rows}


def test_patience_keeps_the_best_round(boosting):
    (fit,) = boosting.grow([Setting(rounds=60, rate=0.9, depth=5, penalty=0.0)], [None], patience=3)
    assert len(fit.trees) == fit.best() + 3 < 60
    assert fit.held[fit.best()] == min(fit.held)
    assert len(boosting.ensemble(fit).trees) == fit.best()


def test_ensemble_predicts_what_the_fit_says(spark, boosting):
    (fit,) = boosting.grow([Setting(rounds=4, rate=0.5, rows=0.7, columns=0.5, by_node=True)], [1])
    (again,) = boosting.grow([Setting(rounds=4, rate=0.5, rows=0.7, columns=0.5, by_node=True)], [1])
    assert fit == again
    rows = spark.createDataFrame(data(240), "a double, b double, c double, y double, fold int, holdout boolean, key long")
    scored = boosting.ensemble(fit).transform(rows.withColumn("prediction", F.lit("x")))
    assert scored.columns == [*rows.columns, "prediction"]
    error = scored.where("holdout and fold != 1").agg(F.sqrt(F.avg(F.pow(F.col("prediction") - F.col("y"), 2)))).first()[0]
    assert error == pytest.approx(fit.held[fit.best()], abs=1e-5)


def test_odd_tables(spark):
    schema = "a double, b double, c double, y double, fold int, holdout boolean, key long"
    empty = Boosting(spark.createDataFrame([], schema), NAMES, "y")
    (fit,) = empty.grow([Setting(rounds=2)], [None])
    assert empty.ensemble(fit).transform(spark.createDataFrame(data(3), schema)).select("prediction").distinct().first()[0] == 0.0
    same = Boosting(spark.createDataFrame([(None, 1.0, 2.0, 5.0, 0, False, 1), (None, 1.0, 2.0, None, 0, None, 2)] * 3, schema), NAMES, "y")
    (fit,) = same.grow([Setting(rounds=2)], [None])
    assert fit.base == 5.0 and len(fit.trees) == 2 and not fit.trees[0].splits


def test_samples_and_published_settings():
    import numpy as np
    import pyarrow as pa

    share = (hashed(42, 3, 7, np.arange(-5000, 5000)) < 0.6).mean()
    assert 0.58 < share < 0.62
    assert binned([pa.array([None, math.nan, 0.0, 1.0, 1.5, 9.0])], [(1.0, 2.0)]).ravel().tolist() == [0, 0, 1, 1, 2, 3]
    for name in forecast.GROWN:
        settings = forecast.grown_settings(name)
        assert len(settings) == len(set(settings)) == 20


def test_search_grows_the_best_draw(spark):
    rows = [(str(p), 2020, w, *[math.log(1 + (p + w * k) % 7) for k in range(len(forecast.FEATURES))], math.log(1 + p)) for p in range(20) for w in range(1, 9)]
    names = ["PRODUCT_ID", "WEEK_NUMBER_CYCLE", "WEEK_NUMBER", *forecast.FEATURES, forecast.LABEL]
    train = spark.createDataFrame(rows, names)
    small = {"rounds": [2], "depth": [2]}
    for name in ("XG", "GB"):
        fits, best = forecast.grown_search(name, train, forecast.Search(draws=2, folds=3, spaces={name: small}))
        assert len(fits) == 6 and all(f.error() >= 0 for f in fits)
        assert best().transform(train).count() == 160
