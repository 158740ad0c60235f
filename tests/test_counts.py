"""Fits on equal rows counted once against fits on all rows."""

from __future__ import annotations

import random
from dataclasses import replace

import pytest

from catalog import models as registered
from panelwright.operators.lags import LagSpec
from panelwright.operators.splits import Bounds
from panelwright.plans import forecast, models, search, validation
from panelwright.storage import materialize

BOUNDS = Bounds(1, 20, 30, 40)


@pytest.fixture(scope="module")
def problems(spark):
    """The same problem on rows and on counted rows: few values, one flag that is rarely 0, one missing at times."""
    rng = random.Random(7)
    rows = []
    for i in range(60):
        for t in range(1, 41):
            a, b = int(rng.random() < 0.95), rng.choice([0, 1, None])
            rows.append((i * 100 + t, t, a, b, None if t > 30 else 3.0 * a + (b or 0) + rng.randrange(4)))
    df = materialize(spark.createDataFrame(rows, "id long, t int, a int, b int, y double"), "few")
    params = models.TreeParams(rounds=6, learning_rate=0.4, depth=2, min_rows=5, tolerance=0.0001)
    plain = validation.Problem(df, "t", "y", BOUNDS, params)
    return plain, validation.counted(plain, ["a", "b"])


def test_counted_rows_give_the_same_fits(problems):
    plain, counts = problems
    assert counts.counts.count() < 0.6 * plain.rows.count()
    for names in (["a", "b"], ["b"]):
        one, two = (validation.validate(p, names, 2) for p in problems)
        assert one.rounds == two.rounds and one.scores == pytest.approx(two.scores, abs=1e-9)
        assert one.importances() == pytest.approx(two.importances(), abs=1e-9)
        one, two = (validation.cross_validate(p, names, 2) for p in problems)
        assert vars(one).keys() == vars(two).keys() and one.rounds == two.rounds
        for k in ("score", "score_std", "score_train"):
            assert getattr(one, k) == pytest.approx(getattr(two, k), abs=1e-9)
    one, two = (forecast.fit_bank(p, LagSpec(-3, -4, -3, 0.0), ["a", "b"]) for p in problems)
    for a, b in ((one.test, two.test), (one.final, two.final)):
        pick = lambda f: {r.id: r.forecast for r in f.predict(plain.rows).collect()}  # noqa: B023, E731
        assert a.rounds == b.rounds and pick(a) == pytest.approx(pick(b), abs=1e-9)


def test_least_rows_of_a_leaf_count_all_rows(spark, problems):
    plain, _ = problems
    smaller = plain.rows.where("a = 0 AND t <= 20").count()
    for least in (smaller - 1, smaller, smaller + 1, 5000):
        params = replace(plain.params, min_rows=least, depth=1, rounds=1)
        one, two = (validation.validate(replace(p, params=params), ["a"]) for p in problems)
        nodes = [sorted((n.node, n.feature, n.rows) for n in f.nodes(spark).collect()) for f in (one, two)]
        assert nodes[0] == nodes[1] and len(nodes[0]) == (3 if least <= smaller else 1)
    trials = [search.search_params(p, ["a"], 2, 5, "min_rows") for p in problems]
    assert [t.values for t in trials[0]] == [t.values for t in trials[1]]
    assert [t.score for t in trials[0]] == pytest.approx([t.score for t in trials[1]], abs=1e-9)


def test_many_values_stay_rows(spark):
    df = spark.range(8000).selectExpr("id", "cast(id % 40 + 1 as int) AS t", "id AS a", "cast(id as double) AS y")
    assert validation.counted(validation.Problem(df, "t", "y", BOUNDS, models.TreeParams()), ["a"]).counts is None


def test_registered_stumps_read_counted_rows(spark):
    p = registered.stump_problem(spark, "/root/testdata/sf0.001")
    rows, weight = p.fitted_on([registered.FLAG])
    assert weight == models.COUNT and rows.agg({weight: "sum"}).first()[0] == p.rows.where("num_orders IS NOT NULL").count()
