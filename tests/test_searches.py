"""Score stores, resumed runs, speculative choices, split counts, regions and single-pass baselines."""

from __future__ import annotations

import itertools
import random
import threading
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from catalog import QUERIES
from panelwright import storage
from panelwright.operators import scoring
from panelwright.operators.lags import LagSpec
from panelwright.operators.splits import Bounds
from panelwright.plans import forecast, models, search, selection, validation
from panelwright.plans.ledger import Ledger
from panelwright.spec import PanelSpec
from panelwright.storage import materialize, new_path

PANEL = PanelSpec(("k",), "t", "id", "y", max_rows=40)
BOUNDS = Bounds(1, 20, 30, 40)
SPECS = [LagSpec(-h, -h - 3, min(0, 10 - h), 0.0, ("log_y",), ("x",)) for h in (1, 2)]


@pytest.fixture(scope="module")
def planted(spark):
    """Demand that follows a known input and the previous row; a third of the series is much noisier."""
    rng, rows = random.Random(4), []
    for k in range(60):
        level = 2.0
        for t in range(1, 41):
            x = rng.randrange(3)
            level = 0.5 * level + x + rng.random() * (2.0 if k % 3 == 0 else 0.05)
            rows.append((k * 100 + t, k, t, x, 5 * (k % 3 == 0), None if t > 30 else level))
    df = spark.createDataFrame(rows, "id long, k int, t int, x int, c long, log_y double")
    params = models.TreeParams(rounds=4, learning_rate=0.4, depth=3, min_rows=5, tolerance=0.0001)
    return validation.Problem(materialize(df, "planted"), "t", "log_y", BOUNDS, params)


@pytest.fixture
def fits(monkeypatch):
    """Counts fits, in all threads."""
    made, lock, plain = [], threading.Lock(), models.fit_trees

    def counted(*args, **kwargs):
        with lock:
            made.append(args[1])
        return plain(*args, **kwargs)

    monkeypatch.setattr(validation, "fit_trees", counted)
    monkeypatch.setattr(forecast, "fit_trees", counted)
    return made


def test_ledger_keeps_values_for_the_next_driver(spark):
    root = new_path(spark, "ledger")
    one = Ledger(spark, root)
    assert one.get({"a": 1}) is None and len(one) == 0
    one.put({"a": 1, "b": ["x", "é"]}, {"score": 0.1, "names": ["p", "q"]})
    one.put("plain", [1, None, float("inf")])
    two = Ledger(spark, root)
    assert two.get({"b": ["x", "é"], "a": 1}) == {"score": 0.1, "names": ["p", "q"]} and len(two) == 2
    two.put("plain", [1, None, float("inf")])  # the same step again does no harm
    assert Ledger(spark, root).once("plain", lambda: pytest.fail("known")) == [1, None, float("inf")]


def test_scores_are_fitted_once_for_a_set(spark, planted, fits):
    rows, matrix = models.stored_matrix(planted.rows, ["x", "c", "k"], ["t", "log_y"])
    scores = validation.CvScores(replace(planted, rows=rows, matrix=matrix), 2)
    one, two, three = scores.many([["x", "c"], ["c", "x", "c"], ["x"]])
    assert one == two and one != three and len(fits) == 4
    assert scores(["c", "x"]) == one and len(fits) == 4
    plain = validation.cross_validate(planted, ["c", "x"], 2, refit=False)
    assert abs(plain.score - one.score) < 1e-9 and abs(plain.score_std - one.score_std) < 1e-9


def test_pooled_score_equals_that_of_all_rows(spark):
    rng = random.Random(1)
    rows = [(k % 3, rng.gauss(k % 3, 2), rng.gauss(0, 1)) for k in range(200)]
    df = spark.createDataFrame(rows, "fold int, actual double, forecast double")
    stats = []
    for k in range(3):
        y, e = [r[1] for r in rows if r[0] == k], [r[2] - r[1] for r in rows if r[0] == k]
        mean, var = lambda v: sum(v) / len(v), lambda v: sum((x - sum(v) / len(v)) ** 2 for x in v) / len(v)
        stats.append(validation.FoldFit(3, len(y), mean(y), var(y), mean(e), var(e)))
    found = validation.pooled_score(stats)
    assert abs(found.score - scoring.cv_score(df).first()["score"]) < 1e-9
    assert abs(found.score_std - scoring.cv_score_spread(df, 3).first()["score_std"]) < 1e-9


def worth(names):
    gains = {"a": 3, "b": 1, "c": -2, "ab": 2, "bc": -1, "d": 0.5}
    return sum(gains[n] for n in names)


def test_scoring_ahead_makes_the_same_choices():
    groups = [["a"], ["b"], ["c"], ["ab", "a", "b"], ["bc", "b", "c"], ["d"]]
    rng = random.Random(2)
    for start, shuffle in itertools.product([["c"], ["a", "bc"], ["d"]], range(5)):
        importances = [rng.random() for _ in groups]
        one, *others = (selection.forward_backward(worth, start, groups, importances, parallelism=n) for n in (1, 2, 3, 8))
        assert all((o.features, o.score, o.steps) == (one.features, one.score, one.steps) for o in others), shuffle


def test_lag_search_goes_on_where_it_stopped(spark, planted, fits):
    first = LagSpec(-1, -3, 0, 0.4, ("log_y",), ("x",))
    root = new_path(spark, "search")
    whole = search.search_horizons(replace(planted, ledger=Ledger()), PANEL, first, (1, 2), ["c"], 2, 4)
    made = len(fits)
    assert [s.horizon for s, _ in whole] == [1, 2] and made > 0
    # A driver is lost after the first horizon; the next one fits only what the second horizon needs.
    part = search.search_horizons(replace(planted, ledger=Ledger(spark, root)), PANEL, first, (1,), ["c"], 2, 4)
    assert part == whole[:1]
    before = len(fits)
    assert search.search_horizons(replace(planted, ledger=Ledger(spark, root)), PANEL, first, (1, 2), ["c"], 2, 4) == whole
    assert len(fits) - before == made - (before - made) > 0
    after = len(fits)
    assert search.search_horizons(replace(planted, ledger=Ledger(spark, root)), PANEL, first, (1, 2), ["c"], 2, 4) == whole
    assert len(fits) == after


def test_forecasts_go_on_where_they_stopped(spark, planted, fits):
    p = forecast.lag_problem(planted, PANEL, SPECS, ["x", "c"])
    root = new_path(spark, "bank")
    one = forecast.forecast_horizons(p, PANEL, forecast.fit_horizons(p, SPECS[:1], ["x", "c"], root))
    made = len(fits)
    both = forecast.fit_horizons(p, SPECS, ["x", "c"], root)
    assert len(fits) == 2 * made
    again = forecast.fit_horizons(p, SPECS, ["x", "c"], root)
    assert len(fits) == 2 * made and [b.test.scores for b in again] == [b.test.scores for b in both]
    pick = lambda banks: forecast.forecast_horizons(p, PANEL, banks).orderBy("stage", "id").collect()
    assert pick(again[:1]) == one.orderBy("stage", "id").collect()


def test_matrix_and_columns_give_the_same_forecasts(spark, planted):
    p, q = forecast.lag_problem(planted, PANEL, SPECS[:1]), forecast.lag_problem(planted, PANEL, SPECS[:1], ["x", "c"])
    found = [forecast.forecast_horizons(x, PANEL, forecast.fit_horizons(x, SPECS[:1], ["x", "c"])) for x in (p, q)]
    one, two = ({(r.stage, r.id): r.log_forecast for r in f.collect()} for f in found)
    assert one.keys() == two.keys() and all(abs(one[k] - two[k]) < 1e-9 for k in one)


def test_noisy_series_get_wider_bands(spark, planted):
    rng = random.Random(9)
    rows = [(k * 100 + t, k, t, 5 * (k % 3 == 0)) for k in range(60) for t in range(1, 41)]
    rows = [(*r, None if r[2] > 30 else 3.0 + r[3] + rng.gauss(0, 1.0 if r[3] else 0.05)) for r in rows]
    df = materialize(spark.createDataFrame(rows, "id long, k int, t int, c long, log_y double"), "noisy")
    specs = [LagSpec(-1, -2, -1, 0.0)]
    p = forecast.lag_problem(validation.Problem(df, "t", "log_y", BOUNDS, planted.params), PANEL, specs, ["c"])
    banks = forecast.fit_horizons(p, specs, ["c"])
    found = materialize(forecast.forecast_horizons(p, PANEL, banks, {"final": banks}), "found")
    shifts = forecast.region_quantiles(found, (0.05, 0.95), least=15)
    final = found.where("stage = 'final'")
    bands = forecast.region_intervals(final, shifts, PANEL, (0.05, 0.95))
    wide = bands.groupBy("id").pivot("alpha", ["0.05", "0.95"]).agg(F.first(F.log1p("forecast")))
    width = wide.select((F.col("id") / 100 % 3 < 1).alias("noisy"), (F.col("`0.95`") - F.col("`0.05`")).alias("w"))
    by = {r.noisy: r.w for r in width.groupBy("noisy").agg(F.avg("w").alias("w")).collect()}
    assert by[True] > 5 * by[False] and wide.count() == 60
    # Too few errors in every region: one band for all.
    same = forecast.region_intervals(final, forecast.region_quantiles(found, (0.05, 0.95), least=1000), PANEL, (0.05, 0.95))
    plain = forecast.interval_forecasts(final.drop("region", "own_region"), forecast.residual_quantiles(found, (0.05, 0.95)), PANEL)
    key = lambda d: sorted((r.id, r.alpha, round(r.forecast, 9)) for r in d.collect())
    assert key(same) == key(plain)


def test_split_counts_add_up_to_the_inner_nodes(spark, planted):
    fitted = validation.validate(planted, ["x", "c", "k"])
    nodes = fitted.nodes(spark).collect()
    inner = [n for n in nodes if n.left >= 0]
    counts = fitted.split_counts(spark)
    assert sum(counts.values()) == len(inner) > 0 and len(nodes) == 2 * len(inner) + fitted.rounds
    assert counts["x"] > 0 and {f for f, n in counts.items() if n} >= {f for f, v in fitted.importances().items() if v > 0}


@pytest.mark.parametrize("max_rows", [40, None])
def test_baseline_of_two_stages_against_a_loop(spark, max_rows):
    rng = random.Random(3)
    rows = [(100 * k + t, k if k < 9 else None, t, rng.randrange(50) if rng.random() < 0.9 else None) for k in range(10) for t in range(1, 31) if rng.random() < 0.6]
    rows += [(5000, 77, 29, 4)]
    df = spark.createDataFrame(rows, "id long, k int, t int, y int")
    found = scoring.origin_baseline(df, PanelSpec(("k",), "t", "id", "y", max_rows=max_rows), {"a": (10, 20), "b": (20, 30)})
    want = []
    for stage, origin, end in (("a", 10, 20), ("b", 20, 30)):
        for i, k, t, y in rows:
            if origin < t <= end:
                past = [r[3] for r in rows if r[1] == k and r[2] <= origin and r[3] is not None]
                want.append((stage, i, k, t, y, sum(past) / len(past) if past and k is not None else None))
    got = [tuple(r) for r in found.select("stage", "id", "k", "t", "actual", "forecast").collect()]
    rounded = lambda rs: sorted(((*r[:5], None if r[5] is None else round(r[5], 9)) for r in rs), key=repr)
    assert rounded(got) == rounded(want)


@pytest.mark.parametrize("name", ["score_rmse", "score_sheet", "score_r2", "worst_residuals", "forecast_baseline", "submission"])
def test_scores_read_the_facts_once(spark, name):
    plan = QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("lineitem.parquet") <= 1


def test_local_folders_are_refused_on_a_cluster():
    assert storage.one_machine("local") and storage.one_machine("local[8]")
    assert not storage.one_machine("local-cluster[2,1,1024]") and not storage.one_machine("yarn") and not storage.one_machine("spark://a:1")


def test_scratch_of_one_thread_leaves_the_tables_of_others(spark):
    inside, stored, problem = threading.Event(), threading.Event(), []

    def other():
        inside.wait(30)
        table = materialize(spark.range(5), "other")
        stored.set()
        problem.append(table)

    thread = threading.Thread(target=other)
    thread.start()
    with storage.scratch(spark):
        mine = materialize(spark.range(3), "mine")
        inside.set()
        assert stored.wait(60)
        made = validation.run_together([lambda: materialize(spark.range(2), "theirs") for _ in range(2)], 2)
        assert mine.count() == 3 and made[0].count() == 2
    thread.join()
    assert problem[0].count() == 5  # still there
    with pytest.raises(Exception, match="(?i)exist|not found"):
        made[0].count()


def test_one_quantile_of_one_stage_opens_its_own_files(spark):
    from panelwright.sources.writers import read_forecasts, write_forecasts

    path = new_path(spark, "long")
    rows = [(s, a, i, float(i)) for s in ("test", "final") for a in ("l2", "0.05", "0.95") for i in range(4)]
    write_forecasts(spark.createDataFrame(rows, "stage string, alpha string, id int, forecast double"), path)
    read = read_forecasts(spark, path, "final", "0.95")
    plan = read._jdf.queryExecution().executedPlan().toString()
    filters = next(part for part in plan.split("PartitionFilters: ")[1:]).split("PushedFilters")[0]
    assert "stage" in filters and "alpha" in filters and len(read.inputFiles()) >= 1
    assert sorted(r.id for r in read.collect()) == [0, 1, 2, 3]


def test_stopping_and_scaling_decide(spark):
    found = {(r.stage, r.horizon): (r.best, r.refit) for r in QUERIES["boosting_rounds"](spark, "/root/testdata/sf0.001").collect()}
    assert found["final", 1] == (2, 2) and found["test", 1] == (3, 3) and found["test", 10] == (3, 4)


def test_steps_are_run_again_where_spark_loses_their_number():
    from pyspark.errors import NumberFormatException

    class Lost(NumberFormatException):
        def __init__(self, text):
            self.text = text

        def __str__(self):
            return self.text

    def step(failures, text):
        left = [failures]

        def run():
            if left[0]:
                left[0] -= 1
                raise Lost(text)
            return "done"

        return run

    assert models.unraced(step(3, "Cannot parse null string")) == "done"
    assert validation.run_together([step(2, "Cannot parse null string")], 1) == ["done"]
    for failures, text in ((9, "Cannot parse null string"), (1, "another")):
        with pytest.raises(NumberFormatException):
            models.unraced(step(failures, text))
