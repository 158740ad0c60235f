"""Selection and search with stand-in scorers, and model fits on a small planted signal."""

from __future__ import annotations

import itertools
import os
import random

import pytest
from pyspark.sql import functions as F

from panelwright.operators import encoding
from panelwright.operators.lags import LagSpec
from panelwright.operators.splits import Bounds
from panelwright.plans import forecast, models, search, selection, validation
from panelwright.sources.writers import read_forecasts, write_forecasts
from panelwright.spec import PanelSpec
from panelwright.storage import materialize, new_path, shared_folder

GROUPS = [["a"], ["b"], ["c"], ["ab", "a", "b"], ["bc", "b", "c"]]


def test_leaving_with():
    every = range(len(GROUPS))
    assert selection.leaving_with(GROUPS, 0, every) == {"a", "ab"}
    assert selection.leaving_with(GROUPS, 1, every) == {"b", "ab", "bc"}
    assert selection.leaving_with(GROUPS, 3, every) == {"ab"}
    assert selection.leaving_with(GROUPS, 3, [3]) == {"ab", "a", "b"}


def worth(names):
    gains = {"a": 3, "b": 1, "c": -2, "ab": 2, "bc": -1}
    return sum(gains[n] for n in names)


def test_forward_backward_reaches_the_best_set():
    best = max((worth(s), set(s)) for r in range(1, 6) for s in itertools.combinations(["a", "b", "c", "ab", "bc"], r))
    found = selection.forward_backward(worth, ["c"], GROUPS)
    assert (found.score, set(found.features)) == best
    importances = [5, 4, 3, 2, 1]
    assert selection.forward_backward(worth, ["c"], GROUPS, importances).score == best[0]


def test_first_improvement_wins_with_importances():
    tried = []

    def scorer(names):
        tried.append(tuple(names))
        return worth(names)

    selection.forward_backward(scorer, ["c"], GROUPS, [1, 9, 0, 2, 0])
    assert tried[1] == ("c", "b")


def test_selection_stops_after_two_misses():
    found = selection.forward_backward(lambda names: 0.0, ["a"], GROUPS)
    assert found.features == ["a"] and not found.steps


def test_rank_groups():
    ranking = selection.rank_groups(worth, ["c"], GROUPS, keep=1)
    assert ranking.ranked[0] == (["ab", "a", "b"], 4) and set(ranking.features) == {"c", "ab", "a", "b"}
    assert ["bc", "b", "c"] not in ranking.groups and ["a"] in ranking.groups
    assert selection.most_important({"x": 1, "y": 3, "z": 2}, 2) == ["y", "z"]


def test_random_search_is_repeatable_and_in_range():
    space = {"rate": search.Range(0.02, 0.5, log=True), "rows": search.Range(10, 300, whole=True, log=True),
             "t": search.Range(-20, -2, whole=True)}
    one = search.random_search(lambda v: -abs(v["rate"] - 0.1), space, 20, seed=3, start=[{"rate": 0.1, "rows": 10, "t": -2}])
    two = search.random_search(lambda v: -abs(v["rate"] - 0.1), space, 20, seed=3, start=[{"rate": 0.1, "rows": 10, "t": -2}])
    assert one == two and one[0].values["rate"] == 0.1 and len(one) == 20
    for t in one:
        assert 0.02 <= t.values["rate"] <= 0.5 and 10 <= t.values["rows"] <= 300 and -20 <= t.values["t"] <= -2
        assert isinstance(t.values["rows"], int)


PANEL = PanelSpec(("k",), "t", "id", "y", max_rows=40)
BOUNDS = Bounds(1, 20, 30, 40)


@pytest.fixture(scope="module")
def planted(spark):
    """Demand that follows a known input and the previous row, for 60 series of 40 periods."""
    rng, rows = random.Random(4), []
    for k in range(60):
        level = 2.0
        for t in range(1, 41):
            x = rng.randrange(3)
            level = 0.5 * level + x + rng.random() * 0.1
            rows.append((k * 100 + t, k, t, x, k % 3, None if t > 30 else level, level))
    df = spark.createDataFrame(rows, "id long, k int, t int, x int, c long, log_y double, truth double")
    params = models.TreeParams(rounds=15, learning_rate=0.4, depth=4, min_rows=5, tolerance=0.0001)
    return validation.Problem(materialize(df, "planted"), "t", "log_y", BOUNDS, params)


SPECS = [LagSpec(-h, -h - 3, min(0, 10 - h), 0.0, ("log_y",), ("x",)) for h in (1, 2)]


def test_validation_finds_the_signal(planted):
    fitted = validation.validate(planted, ["x", "c"])
    assert fitted.scores["test"] > 0.5 and fitted.scores["train"] > 0.5
    assert fitted.importances()["x"] > fitted.importances()["c"]


def test_cross_validation_scores(planted):
    good = validation.cross_validate(planted, ["x", "c"], 2)
    assert good.score > validation.cross_validate(planted, ["c"], 2, refit=False).score
    assert good.rounds >= 1 and good.score_std >= 0 and good.importances["x"] > 0.5
    test = validation.cross_validate(planted, ["x"], 1, back_test=True)
    assert test.score_test is not None


def test_lags_help(planted):
    table = {label: (test, cv) for label, test, cv in search.compare_lags(planted, PANEL, SPECS[0], ["x"], 2)}
    assert table["with lags"][0] > table["without lags"][0] and table["with lags"][1] > table["without lags"][1]


def test_forecasts_intervals_and_saved_models(spark, planted):
    p = forecast.lag_problem(planted, PANEL, SPECS)
    root = new_path(spark, "bank")
    banks = forecast.fit_horizons(p, SPECS, ["x", "c"], root)
    found = materialize(forecast.forecast_horizons(p, PANEL, banks), "found")
    assert {(r.stage, r.horizon, r.t) for r in found.select("stage", "horizon", "t").distinct().collect()} == {
        ("test", 1, 21), ("test", 2, 22), ("final", 1, 31), ("final", 2, 32)
    }
    assert found.count() == 240 and found.where("forecast < 0 OR forecast IS NULL").count() == 0
    truth = planted.rows.select("id", "truth")
    error = found.where("stage = 'final'").join(truth, "id").agg(F.avg(F.abs(F.col("log_forecast") - F.col("truth")))).first()[0]
    assert error < 0.6

    alphas = (0.05, 0.5, 0.95)
    before = forecast.earlier(p)
    assert (before.bounds.train_time, before.bounds.test_time, before.bounds.end, before.bounds.tstep) == (10, 20, 30, 10)
    past = forecast.forecast_horizons(before, PANEL, forecast.fit_horizons(before, SPECS, ["x", "c"], future=False))
    assert {r.t for r in past.select("t").distinct().collect()} == {11, 12}
    shifts = forecast.residual_quantiles(found, alphas).unionByName(forecast.residual_quantiles(past, alphas, "test"))
    moved = forecast.interval_forecasts(found, shifts, PANEL)
    wide = moved.groupBy("stage", "id").pivot("alpha", ["0.05", "0.5", "0.95"]).agg(F.first("forecast"))
    assert wide.where("`0.05` > `0.5` OR `0.5` > `0.95`").count() == 0 and wide.count() == 240
    path = new_path(spark, "long")
    write_forecasts(forecast.all_forecasts(found, moved), path)
    assert read_forecasts(spark, path, "final", "0.05").count() == 120

    again = forecast.load_bank(spark, root, SPECS[1])
    one, two = (forecast.forecast_horizons(p, PANEL, [b]).orderBy("stage", "id") for b in (banks[1], again))
    assert one.collect() == two.collect()


def test_no_forecast_uses_later_targets(spark, planted):
    """Changing every target after the origin must not change a forecast of that stage."""
    p = forecast.lag_problem(planted, PANEL, SPECS)
    banks = forecast.fit_horizons(p, SPECS, ["x"])
    changed = planted.rows.withColumn("log_y", F.when(F.col("t") > 20, F.lit(99.0)).otherwise(F.col("log_y")))
    q = forecast.lag_problem(validation.Problem(changed, "t", "log_y", BOUNDS, planted.params), PANEL, SPECS)
    pick = lambda d: d.where("stage = 'test'").select("id", "log_forecast").orderBy("id").collect()
    assert pick(forecast.forecast_horizons(p, PANEL, banks)) == pick(forecast.forecast_horizons(q, PANEL, banks))


def test_lag_search_keeps_the_start_setting_as_a_candidate(planted):
    trials = search.search_lags(planted, PANEL, SPECS[0], ["x"], 2, 2)
    assert len(trials) == 2 and {"t_min": -4, "t_max": 0, "power": 0.0} in [t.values for t in trials]


def test_searches_leave_no_table_behind(spark, planted):
    folder = shared_folder(spark).removeprefix("file:")
    before = set(os.listdir(folder))
    search.search_lags(planted, PANEL, SPECS[0], ["x"], 2, 3)
    search.compare_lags(planted, PANEL, SPECS[0], ["x"], 2)
    left = {n for n in set(os.listdir(folder)) - before if n.startswith("lags")}
    assert not left


def test_moves_must_beat_the_spread_and_carry_test_scores():
    noisy = lambda names: selection.Score(worth(names), 2.0)
    plain = selection.forward_backward(noisy, ["c"], GROUPS)
    strict = selection.forward_backward(noisy, ["c"], GROUPS, num_stds=10.0)
    assert plain.steps and not strict.steps and strict.features == ["c"]
    tested = selection.forward_backward(worth, ["c"], GROUPS, tester=lambda names: float(len(names)))
    assert tested.test == len(tested.features) and tested.steps[-1].test == tested.test
    ranking = selection.rank_groups(worth, ["c"], GROUPS, keep=1, tester=lambda names: float(len(names)))
    assert ranking.tests[0] == 4.0 and len(ranking.tests) == len(GROUPS)


def test_one_category_encoding_at_every_size(spark):
    df = spark.sql("SELECT id, cast(id % 7 as string) AS g, CASE WHEN id < 50 THEN cast(6 - id % 7 as double) END AS y FROM range(70)")
    coded = encoding.category_dictionary(df, ["g"], "y").orderBy("code").collect()
    assert [(r["value"], r["code"]) for r in coded] == [(str(6 - k), k) for k in range(7)]


def test_count_model_marks_missing_inputs(spark):
    df = spark.sql("SELECT id, CASE WHEN id % 2 = 0 THEN 1.0D END AS `my x`, CASE WHEN id % 2 = 0 THEN 2 ELSE 8 END AS y FROM range(40)")
    fitted = models.fit_poisson(df, ["my x"], "y")
    assert fitted.missing == ["my x"]
    got = {r["y"]: r["f"] for r in fitted.predict(df).groupBy("y").agg(F.avg("forecast").alias("f")).collect()}
    assert abs(got[2] - 2) < 0.01 and abs(got[8] - 8) < 0.01


def test_lag_search_chooses_known_columns_at_every_horizon(monkeypatch):
    from dataclasses import replace
    from types import SimpleNamespace

    from catalog import models as registered

    asked, tried = [], []

    def select_known(problem, panel, spec, features, nfold, seed=1):
        asked.append((spec.horizon, spec.known, nfold))
        return replace(spec, known=spec.known[:1] if spec.horizon == 1 else spec.known), None

    def search_lags(problem, panel, spec, features, nfold, trials, seed=1):
        tried.append((nfold, trials))
        return [search.Trial({"t_min": spec.t_min, "t_max": spec.t_max, "power": spec.power}, 0.0)]

    monkeypatch.setattr(search, "select_known", select_known)
    monkeypatch.setattr(search, "search_lags", search_lags)
    monkeypatch.setattr(registered, "lag_problem", lambda *a: SimpleNamespace(bounds=registered.BOUNDS))
    monkeypatch.setattr(registered, "report", lambda spark, **columns: columns)
    got = registered.lag_search(None, "")
    assert asked == [(h, registered.KNOWN, 5) for h in range(1, 11)] and tried == [(5, 30)] * 10
    assert got["known"] == [registered.KNOWN[0], *[" ".join(registered.KNOWN)] * 9]
