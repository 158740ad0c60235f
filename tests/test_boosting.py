"""Fits that share their passes over coded rows against Spark's own trees."""

from __future__ import annotations

import random
from dataclasses import replace

import numpy as np
import pytest
from pyspark.sql import functions as F

from catalog import QUERIES
from catalog import models as registered
from panelwright.operators.splits import Bounds
from panelwright.plans import boosting, models, search, validation
from panelwright.storage import materialize

NAMES = ["x", "c", "w", "k"]


@pytest.fixture(autouse=True)
def few_rows_are_coded_too(monkeypatch):
    monkeypatch.setattr(validation, "WHOLE_ROWS", 0)


@pytest.fixture(params=[0, 300])
def halved(request, monkeypatch):
    monkeypatch.setattr(boosting, "HALVED_COLUMNS", request.param)


@pytest.fixture(scope="module")
def planted(spark):
    """Few and many values, some missing, a third of the series much noisier."""
    rng, rows = random.Random(4), []
    for k in range(60):
        level = 2.0
        for t in range(1, 41):
            x = rng.randrange(3)
            level = 0.5 * level + x + rng.random() * (2.0 if k % 3 == 0 else 0.05)
            rows.append((k, t, x, 5 * (k % 3 == 0), rng.choice([None, level + rng.gauss(0, 0.3)]), None if t > 30 else level))
    df = spark.createDataFrame(rows, "k int, t int, x int, c long, w double, y double")
    params = models.TreeParams(rounds=12, learning_rate=0.4, depth=4, min_rows=5, tolerance=0.0001)
    p = validation.Problem(materialize(df, "planted"), "t", "y", Bounds(1, 20, 30, 40), params, parallelism=4)
    rows, matrix = models.stored_matrix(p.rows, NAMES, ["t", "y", *NAMES])
    return replace(p, rows=rows, matrix=matrix)


def same(one, two):
    assert one.rounds == two.rounds and one.importances() == pytest.approx(two.importances(), abs=1e-9)


def test_trees_are_those_of_spark(spark, planted):
    # F1 to F11: one fit read and binned all rows; many fits share their passes now, with the same trees.
    for names, gap in ((NAMES, 0), (["x", "w"], 2), (["k"], 0)):
        alone = validation.validate(planted, names, gap)
        with validation.remembered(planted):
            shared = validation.validate(planted, names, gap)
        assert isinstance(shared, models.Grown) and not isinstance(alone, models.Grown)
        same(alone, shared)
        assert shared.scores == pytest.approx(alone.scores, abs=1e-9)
        # A gain of rounding alone splits nodes of Spark's trees, which changes no forecast.
        pick = lambda f: [tuple(r) for r in f.nodes(spark).where("gain > 1e-12").select("tree", "feature", "rows", "gain").orderBy("tree", "rows", "gain").collect()]
        for a, b in zip(pick(alone), pick(shared), strict=True):
            assert a == pytest.approx(b, abs=1e-9)


def test_cross_validation_is_that_of_spark(planted, halved):
    alone = validation.cross_validate(planted, NAMES, 2)
    with validation.remembered(planted):
        shared = validation.cross_validate(planted, NAMES, 2)
    assert alone.rounds == shared.rounds
    for k in ("score", "score_std", "score_train"):
        assert getattr(alone, k) == pytest.approx(getattr(shared, k), abs=1e-9)


def test_forecasts_of_the_model_are_those_of_the_fit(spark, planted, monkeypatch):
    monkeypatch.setattr(boosting, "HALVED_COLUMNS", 0)
    # Few levels: columns of many values are cut at quantiles, and thresholds hold for values in between.
    monkeypatch.setattr(boosting, "LEVELS", 50)
    monkeypatch.setattr(boosting, "BLOCK_ROWS", 100)
    with validation.remembered(planted):
        assert max(len(v) for v in planted.matrix.coded[0].levels) == 50
        fitted = validation.validate(planted, NAMES)
    scored = fitted.predict(planted.rows.where("t > 20 AND t <= 30"), "f", matrix=planted.matrix)
    error = scored.agg(F.avg(F.pow(F.col("f") - F.col("y"), 2))).first()[0]
    assert error == pytest.approx(fitted.fit.held.squared_error, abs=1e-9) and fitted.scores["test"] > 0.5


def test_fits_of_all_threads_share_their_jobs(planted, monkeypatch):
    groups, grow = [], boosting.Blocks._grow
    monkeypatch.setattr(boosting.Blocks, "_grow", lambda self, fits: groups.append(len(fits)) or grow(self, fits))
    sets = [["x"], ["x", "c"], ["w"], NAMES]
    with validation.remembered(planted):
        alone = [validation.CvScores(planted, 2).many([s])[0] for s in sets]
        groups.clear()
        together = validation.CvScores(planted, 2).many(sets)
        assert groups == [8] and together == alone
        groups.clear()
        nested = validation.run_together(
            [lambda s=s: validation.run_together([lambda: validation.validate(planted, s).scores] * 2, 2) for s in sets], 3
        )
        assert sum(groups) == 8 and groups[0] == 6 and all(a == b for a, b in nested)


def test_a_failing_fit_ends_all_that_wait(planted, monkeypatch):
    with validation.remembered(planted):
        monkeypatch.setattr(boosting.Blocks, "_grow", lambda self, fits: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            validation.CvScores(planted, 2).many([["x"], ["c"]])


def test_candidate_splits_of_a_long_column():
    values, counts = np.arange(1000.0), np.full(1000, 7)
    thresholds, codes = boosting.candidate_splits(values, counts, 10)
    assert len(thresholds) == 9 and set(np.diff(codes)) <= {99, 100, 101}
    assert (thresholds == codes + 0.5).all()
    assert (boosting.candidate_splits(values, counts, 10, whole=False)[0] == codes).all()
    assert len(boosting.candidate_splits(values[:1], counts[:1], 10)[0]) == 0


def test_trials_of_a_search_share_their_jobs(planted, monkeypatch):
    # every trial had fits of its own.
    p = replace(planted, rows=planted.rows.drop(planted.matrix.column), matrix=None)
    groups, grow = [], boosting.Blocks._grow
    monkeypatch.setattr(boosting.Blocks, "_grow", lambda self, fits: groups.append(len(fits)) or grow(self, fits))
    shared = search.search_params(p, ["x", "w"], 2, 3, "learning_rate")
    assert groups == [6]
    monkeypatch.setattr(search, "remembered", lambda problem, few: validation.remembered(replace(problem, matrix=None)))
    alone = search.search_params(p, ["x", "w"], 2, 3, "learning_rate")
    assert groups == [6] and [t.values for t in alone] == [t.values for t in shared]
    assert [t.score for t in alone] == pytest.approx([t.score for t in shared], abs=1e-9)


def test_the_parameter_search_boosts_until_nothing_is_gained(spark, monkeypatch):
    # three rounds left a learning rate hardly anything to decide.
    made, grow = [], boosting.Blocks._grow
    monkeypatch.setattr(boosting.Blocks, "_grow", lambda self, fits: grow(self, fits) or made.extend(fits))
    monkeypatch.setattr(registered, "TRIALS", 2)
    assert QUERIES["param_search"](spark, "/root/testdata/sf0.001").count() == 4
    assert len(made) == 20 and max(len(f.trees) for f in made) > 3 and all(len(f.trees) == f.best + 1 for f in made)


def test_folds_of_a_query_share_their_passes(spark, monkeypatch):
    # the frame stored columns that no fold reads, and every fold binned all rows anew.
    kept, groups, build, grow = [], [], registered.problem, boosting.Blocks._grow
    monkeypatch.setattr(registered, "problem", lambda *a, **named: kept.append(named.get("keep")) or build(*a, **named))
    monkeypatch.setattr(boosting.Blocks, "_grow", lambda self, fits: groups.append(len(fits)) or grow(self, fits))
    assert QUERIES["cv_model"](spark, "/root/testdata/sf0.001").count() == 4
    assert kept == [registered.START] and groups == [5, 1]
