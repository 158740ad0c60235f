"""Model fits, selection, search and forecasts. Few boosting rounds keep a run short; everything else is complete.

Beside the full models stand keys whose model is known exactly: one tree with one split on a 0/1 column predicts the mean
log target of each side, and a log-linear count model on such a column predicts group means. SQL checks those.
"""

from __future__ import annotations

from dataclasses import replace

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalog.base import query
from panelwright.functions.columns import log_target
from panelwright.operators import joins, samples, scoring, series
from panelwright.operators.lags import LagSpec, lag_frames
from panelwright.operators.rows import time_slice
from panelwright.plans import forecast, frames, models, search, selection, validation
from panelwright.plans.ledger import Ledger
from panelwright.sources import fixture, writers
from panelwright.storage import materialize, new_path

SPEC, BOUNDS = fixture.SPEC, fixture.BOUNDS
KEYS = list(SPEC.keys)
#: Parameters of the registered runs: boosting settings (QUICK for selection and searches), folds and trials. Rows, horizons, groups and known columns are complete.
PARAMS = models.TreeParams(rounds=10, learning_rate=0.2, depth=4)
QUICK = models.TreeParams(rounds=3, learning_rate=0.5, depth=3)
#: A parameter search boosts until the held-out rows no longer gain, as the reference does with at most so many rounds: a learning rate decides little in a few rounds.
SEARCHED = models.TreeParams(rounds=10_000)
FOLDS, TRIALS, LAG_TRIALS = 5, 32, 30
START = ["center_id", "meal_id", "checkout_price", "base_price", "emailer_for_promotion", "homepage_featured", "op_area"]
KNOWN = (
    "checkout_price", "base_price", "emailer_for_promotion", "homepage_featured", "center_id_week_count",
    "meal_id_week_count", "week",
)
#: Means of the target so far, by promotion state; known up to the origin only.
STATS = {"mean_all": (), "mean_emailer": ("emailer_for_promotion",), "mean_featured": ("homepage_featured",),
         "mean_promotion": ("emailer_for_promotion", "homepage_featured")}
ALPHAS = (0.05, 0.5, 0.95)
HORIZONS = tuple(range(1, BOUNDS.tstep + 1))
SPECS = tuple(
    LagSpec(-h, -h - 6, min(2, BOUNDS.tstep - h), 0.4, ("log_num_orders",), KNOWN, tuple(STATS)) for h in HORIZONS
)
#: Category codes are ordered by targets that no fold forecasts, whatever its gap.
ORDER_UPTO = BOUNDS.test_time - FOLDS * BOUNDS.tstep - BOUNDS.tstep


def problem(spark, sf_dir, params=PARAMS, keep=None) -> validation.Problem:
    """The problem on the stored frame; ``keep`` names the features that the query reads, all without it."""
    dims = {"center_id": fixture.center_info(spark, sf_dir), "meal_id": fixture.meal_info(spark)}
    built = frames.training_frame(fixture.with_future(spark, sf_dir), dims, SPEC, fixture.CATEGORICAL, fixture.PRICES,
                                  fixture.FLAGS, order_upto=ORDER_UPTO, keep=keep)
    return validation.Problem(built.rows, SPEC.time, built.log_target, BOUNDS, params, parallelism=8)


def lag_problem(spark, sf_dir, params=QUICK) -> validation.Problem:
    """The problem with the means by promotion state that lag settings use."""
    p = problem(spark, sf_dir, params)
    rows = series.expanding_means_by_state(p.rows, SPEC, p.target, STATS)
    kept = dict.fromkeys([SPEC.id, *KEYS, SPEC.time, SPEC.target, p.target, *START, *KNOWN, *STATS])
    return replace(p, rows=materialize(rows.select(*kept), "lag-frame"), ledger=Ledger())


def all_groups() -> list[list[str]]:
    """Every raw and engineered feature group."""
    return frames.raw_groups(fixture.RAW_FEATURES) + frames.engineered_groups(
        fixture.CATEGORICAL, fixture.PRICES, fixture.FLAGS, SPEC.time
    )


def report(spark, **columns) -> DataFrame:
    """A report of driver-side results: a few rows."""
    return spark.createDataFrame(pa.table(columns))


@query("gbt_fit")
def gbt_fit(spark, sf_dir) -> DataFrame:
    features = [*START, "ts_mean", "week_count"]
    fitted = validation.validate(problem(spark, sf_dir, keep=features), features)
    return report(spark, part=["train", "test"], r2=[fitted.scores["train"], fitted.scores["test"]], rounds=[fitted.rounds] * 2)


@query("poisson_fit")
def poisson_fit(spark, sf_dir) -> DataFrame:
    p = problem(spark, sf_dir)
    inputs = [*START, "city_code", "region_code", "center_type", "category", "cuisine", "ts_mean", "week_count"]
    train = time_slice(p.rows, SPEC.time, upto=BOUNDS.train_time)
    test = time_slice(p.rows, SPEC.time, BOUNDS.train_time, BOUNDS.test_time)
    scored = models.fit_poisson(train, inputs, SPEC.target).predict(test)
    rows = scored.select(F.lit("test").alias("stage"), F.col(SPEC.target).alias("actual"), "forecast")
    return scoring.score_sheet(rows, ["stage"])


@query("cv_model")
def cv_model(spark, sf_dir) -> DataFrame:
    p = _vectors(problem(spark, sf_dir, keep=START), START)
    with validation.remembered(p):
        result = validation.cross_validate(p, START, FOLDS)
    names = ["score", "score_std", "score_train", "rounds"]
    return report(spark, measure=names, value=[float(getattr(result, n)) for n in names])


@query("feature_importance")
def feature_importance(spark, sf_dir) -> DataFrame:
    """Importance of every feature with its rank, whether it is among the ten most important, and its group's score."""
    groups = all_groups()
    features = selection.union(*groups)
    found = validation.validate(problem(spark, sf_dir), features).importances()
    ranked = sorted(features, key=lambda f: (-found[f], f))
    top = set(selection.most_important(found, 10))
    scores = dict(zip((g[0] for g in groups), selection.group_importances(groups, found), strict=True))
    return report(spark, feature=ranked, importance=[found[f] for f in ranked], rank=list(range(1, len(ranked) + 1)),
                  top=[f in top for f in ranked], group_importance=[scores.get(f) for f in ranked])


def _vectors(p: validation.Problem, features) -> validation.Problem:
    """The problem with all features in one stored vector."""
    rows, matrix = models.stored_matrix(p.rows, features, [p.time, p.target])
    return replace(p, rows=rows, matrix=matrix)


def _tester(p: validation.Problem):
    return lambda names: validation.validate(p, names).scores["test"]


@query("rank_features")
def rank_features(spark, sf_dir) -> DataFrame:
    p = _vectors(problem(spark, sf_dir, QUICK), selection.union(*all_groups()))
    scores = validation.CvScores(p, FOLDS)
    with validation.remembered(p):
        ranking = selection.rank_groups(scores, ["checkout_price", "homepage_featured"], all_groups(), 10, _tester(p), p.parallelism)
    return report(
        spark, place=list(range(1, len(ranking.ranked) + 1)), names=[" ".join(g) for g, _ in ranking.ranked],
        score=[s for _, s in ranking.ranked], test=ranking.tests, kept=[g in ranking.groups for g, _ in ranking.ranked],
    )


@query("feature_selection")
def feature_selection(spark, sf_dir) -> DataFrame:
    """Forward and backward steps over all groups, from the five most important features."""
    groups = all_groups()
    p = _vectors(problem(spark, sf_dir, QUICK), selection.union(*groups))
    with validation.remembered(p):
        importances = validation.validate(p, selection.union(*groups)).importances()
        start = selection.most_important(importances, 5)
        chosen = selection.forward_backward(
            validation.CvScores(p, FOLDS), start, groups, selection.group_importances(groups, importances), tester=_tester(p),
            num_stds=1.0, parallelism=p.parallelism,
        )
    last = selection.Step("chosen", chosen.features, chosen.score, chosen.test)
    steps = [selection.Step("start", start, float("nan")), *chosen.steps, last]
    return report(spark, step=list(range(len(steps))), action=[s.action for s in steps],
                  names=[" ".join(s.names) for s in steps], score=[s.score for s in steps], test=[s.test for s in steps])


@query("param_search")
def param_search(spark, sf_dir) -> DataFrame:
    p = problem(spark, sf_dir, SEARCHED, keep=START)
    rates = search.search_params(p, START, FOLDS, TRIALS, "learning_rate")
    leaves = search.search_params(p, START, FOLDS, TRIALS, "min_rows")
    return report(
        spark, parameter=["learning_rate"] * TRIALS + ["min_rows"] * TRIALS,
        value=[float(v) for t in rates + leaves for v in t.values.values()], score=[t.score for t in rates + leaves],
    )


@query("lag_search")
def lag_search(spark, sf_dir) -> DataFrame:
    p = lag_problem(spark, sf_dir)
    first = LagSpec(-1, -6, 0, 0.46, ("log_num_orders",), KNOWN, tuple(STATS))
    found = search.search_horizons(p, SPEC, first, HORIZONS, ["checkout_price", "homepage_featured"], FOLDS, LAG_TRIALS)
    return report(
        spark, horizon=[s.horizon for s, _ in found], t_min=[s.t_min for s, _ in found], t_max=[s.t_max for s, _ in found],
        power=[s.power for s, _ in found], known=[" ".join(s.known) for s, _ in found], score=[v for _, v in found],
    )


@query("compare_lags")
def compare_lags(spark, sf_dir) -> DataFrame:
    p = lag_problem(spark, sf_dir)
    found = search.compare_settings(p, SPEC, SPECS, START, FOLDS)
    rows = [(s.horizon, *r) for s, variants in zip(SPECS, found, strict=True) for r in variants]
    horizon, variant, test, cv = zip(*rows, strict=True)
    return report(spark, horizon=list(horizon), variant=list(variant), score_test=list(test), score_cv=list(cv))


def _lagged(spark, sf_dir) -> validation.Problem:
    """Features and all lag columns of all horizons as one vector, stored by period."""
    return forecast.lag_problem(lag_problem(spark, sf_dir, PARAMS), SPEC, SPECS, START)


def _forecasts(spark, sf_dir, root: str | None = None) -> DataFrame:
    """Point forecasts of both stages, and the regions that the intervals of the final stage go by."""
    p = _lagged(spark, sf_dir)
    with validation.remembered(p):
        banks = forecast.fit_horizons(p, SPECS, START, root)
    # Forecasts open the files of their periods only.
    return materialize(forecast.forecast_horizons(p, SPEC, banks, {"final": banks}), "forecasts")


@query("forecast_direct")
def forecast_direct(spark, sf_dir) -> DataFrame:
    return _forecasts(spark, sf_dir).select("stage", "horizon", "id", "week", "forecast")


@query("forecast_interval")
def forecast_interval(spark, sf_dir) -> DataFrame:
    found = _forecasts(spark, sf_dir)
    final = found.where("stage = 'final'")
    moved = forecast.region_intervals(final, forecast.region_quantiles(found, ALPHAS), SPEC, ALPHAS)
    path = new_path(spark, "forecasts")
    writers.write_forecasts(forecast.all_forecasts(final, moved), path)
    return writers.read_forecasts(spark, path, stage="final").select("stage", "alpha", "horizon", "id", "week", "forecast")


def everything_forecast(p: validation.Problem, specs, features) -> tuple[DataFrame, DataFrame]:
    """Point and quantile forecasts of both stages; each stage's intervals come from errors before it, by region."""
    before = forecast.earlier(p)
    tasks = [lambda: forecast.fit_horizons(p, specs, features), lambda: forecast.fit_horizons(before, specs, features, future=False)]
    with validation.remembered(p):
        features_at_most = max(len(features) + len(lag_frames(s, p.bounds.tstep)) for s in specs)
        roomy = validation.fits_at_once(p, features_at_most) == p.parallelism
        banks, past_banks = validation.run_together(tasks, 2 if roomy else 1)
    found = materialize(forecast.forecast_horizons(p, SPEC, banks, {"final": banks, "test": past_banks}), "forecasts")
    past = forecast.forecast_horizons(before, SPEC, past_banks)
    shifts = forecast.region_quantiles(found, ALPHAS, "final").unionByName(forecast.region_quantiles(past, ALPHAS, "test"))
    return found, forecast.region_intervals(found, shifts, SPEC, ALPHAS)


def _with_intervals(spark, sf_dir) -> DataFrame:
    return forecast.all_forecasts(*everything_forecast(_lagged(spark, sf_dir), SPECS, START))


@query("forecast_scores")
def forecast_scores(spark, sf_dir) -> DataFrame:
    """Score sheet of point and quantile forecasts for the back-test and the final stage, next to the series mean."""
    everything = _with_intervals(spark, sf_dir).select("stage", "alpha", "id", "forecast")
    mean = _stage_baseline(spark, sf_dir).withColumn("alpha", F.lit("mean"))
    mean = mean.join(everything.select("id").distinct(), "id", "left_semi").select(*everything.columns)
    truth = fixture.panel(spark, sf_dir)
    pairs = joins.align(truth, everything.unionByName(mean), SPEC.id, SPEC.target)
    return scoring.score_sheet(pairs, ["stage", "alpha"])


def _stage_baseline(spark, sf_dir) -> DataFrame:
    """Series means known at the origin of each stage, for the rows that stage forecasts."""
    stages = {"test": (BOUNDS.train_time, BOUNDS.test_time), "final": (BOUNDS.test_time, BOUNDS.end)}
    return scoring.origin_baseline(fixture.with_future(spark, sf_dir), SPEC, stages).drop(scoring.ACTUAL)


@query("forecast_compare")
def forecast_compare(spark, sf_dir) -> DataFrame:
    # The stored frame carries encoded keys; forecasts are matched to the original ones by id.
    rows = fixture.with_future(spark, sf_dir)
    originals = rows.select(SPEC.id, *KEYS)
    everything = _with_intervals(spark, sf_dir).drop(*KEYS).join(originals, SPEC.id)
    chosen = samples.sample_series(rows, KEYS, 5, 1)
    return forecast.compare_forecasts(rows, everything, _stage_baseline(spark, sf_dir), chosen, SPEC,
                                      ["checkout_price", "emailer_for_promotion", "homepage_featured", "num_orders"], ALPHAS)


@query("model_roundtrip", "panel", sql="""
SELECT CAST(count(*) AS BIGINT) AS rows, CAST(0 AS DOUBLE) AS largest_change FROM panel WHERE week > 73""")
def model_roundtrip(spark, sf_dir) -> DataFrame:
    """Save a fitted model, load it, and compare the forecasts of both on all future rows."""
    p = problem(spark, sf_dir, QUICK, START)
    fitted = models.fit_trees(time_slice(p.rows, SPEC.time, upto=BOUNDS.test_time), START, p.target, p.params)
    path = models.model_path(new_path(spark, "models"), "final", None, forecast.POINT)
    fitted.save(spark, path)
    future = time_slice(p.rows, SPEC.time, BOUNDS.test_time)
    both = models.Fitted.load(spark, path).predict(fitted.predict(future, "before"), "after")
    return both.agg(F.count(F.lit(1)).alias("rows"), F.max(F.abs(F.col("after") - F.col("before"))).alias("largest_change"))


# One tree with one split on a 0/1 column.
STUMP = models.TreeParams(rounds=1, depth=1, min_rows=1)
STUMP_SPECS = tuple(LagSpec(-h, -h - 1, -h, 0.0) for h in HORIZONS)
FLAG = "homepage_featured"


def stump_problem(spark, sf_dir) -> validation.Problem:
    rows = fixture.with_future(spark, sf_dir)
    rows = rows.withColumn("log_num_orders", log_target("num_orders"))
    p = validation.Problem(materialize(rows, "stump"), SPEC.time, "log_num_orders", BOUNDS, STUMP)
    return validation.counted(p, fixture.FLAGS)


def stump_forecasts(spark, sf_dir) -> tuple[validation.Problem, DataFrame]:
    p = stump_problem(spark, sf_dir)
    banks = forecast.fit_horizons(p, STUMP_SPECS, [FLAG])
    return p, materialize(forecast.forecast_horizons(p, SPEC, banks), "stump-forecasts")


_STUMP = """
SELECT s.stage, CAST(p.week - s.origin AS INT) AS horizon, p.id, p.week, p.num_orders, m.mean, ln(p.num_orders + 1) AS log_actual
FROM panel p JOIN (VALUES ('test', 63), ('final', 73)) s(stage, origin) ON p.week > s.origin AND p.week <= s.origin + 10
JOIN (SELECT origin, homepage_featured, avg(ln(num_orders + 1)) AS mean FROM panel JOIN (VALUES (63), (73), (53)) o(origin) ON week <= origin
      GROUP BY ALL) m ON m.origin = s.origin AND m.homepage_featured = p.homepage_featured"""
_STUMP_EARLY = _STUMP.replace("('test', 63), ('final', 73)", "('test', 53)")
_SHIFTS = """
SELECT {stage} AS stage, horizon, unnest([0.05, 0.5, 0.95]) AS alpha, unnest(q) AS shift
FROM (SELECT horizon, quantile_cont(log_actual - mean, [0.05, 0.5, 0.95]) AS q FROM ({rows}) WHERE {where} GROUP BY horizon)"""
_STUMP_ALL = f"""
SELECT stage, 'l2' AS alpha, id, num_orders, exp(mean) - 1 AS forecast FROM ({_STUMP})
UNION ALL SELECT f.stage, CAST(CAST(s.alpha AS DOUBLE) AS VARCHAR), id, num_orders, exp(greatest(mean + shift, 0)) - 1
FROM ({_STUMP}) f JOIN ({_SHIFTS.format(stage="'final'", rows=_STUMP, where="stage = 'test'")}
  UNION ALL {_SHIFTS.format(stage="'test'", rows=_STUMP_EARLY, where="true")}) s USING (stage, horizon)"""


@query("stump_forecast", "panel", sql=f"""
SELECT stage, horizon, id, week, round(exp(mean) - 1, 6) AS forecast FROM ({_STUMP})""")
def stump_forecast(spark, sf_dir) -> DataFrame:
    """Forecasts of all horizons and both stages by a model whose answer SQL knows."""
    _, found = stump_forecasts(spark, sf_dir)
    return found.select("stage", "horizon", "id", "week", F.round("forecast", 6).alias("forecast"))


def _stump_everything(spark, sf_dir) -> DataFrame:
    p, found = stump_forecasts(spark, sf_dir)
    before = forecast.earlier(p)
    past = forecast.forecast_horizons(before, SPEC, forecast.fit_horizons(before, STUMP_SPECS, [FLAG], future=False))
    shifts = forecast.residual_quantiles(found, ALPHAS, "final").unionByName(forecast.residual_quantiles(past, ALPHAS, "test"))
    return forecast.all_forecasts(found, forecast.interval_forecasts(found, shifts, SPEC))


@query("stump_intervals", "panel", sql=f"SELECT stage, alpha, id, round(forecast, 5) AS forecast FROM ({_STUMP_ALL})")
def stump_intervals(spark, sf_dir) -> DataFrame:
    """Point and quantile forecasts; the quantiles come from errors before the stage."""
    return _stump_everything(spark, sf_dir).select("stage", "alpha", "id", F.round("forecast", 5).alias("forecast"))


# Back-test errors of the stump by horizon and side of its split, and the quantiles that a side of 20 errors or more has.
_SIDES, _SIDES_EARLY = (x.replace("p.week, ", "p.week, p.homepage_featured AS side, ") for x in (_STUMP, _STUMP_EARLY))
_BY_SIDE = f"""
WITH e AS (SELECT 'final' AS stage, horizon, side, log_actual - mean AS r FROM ({_SIDES}) WHERE stage = 'test'
  UNION ALL SELECT 'test', horizon, side, log_actual - mean FROM ({_SIDES_EARLY})),
q AS (SELECT stage, horizon, side, quantile_cont(r, [0.05, 0.5, 0.95]) AS q FROM e GROUP BY ALL HAVING count(*) >= 20),
w AS (SELECT stage, horizon, quantile_cont(r, [0.05, 0.5, 0.95]) AS q FROM e GROUP BY ALL),
f AS (SELECT f.*, coalesce(q.q, w.q) AS q FROM ({_SIDES}) f JOIN w USING (stage, horizon)
      LEFT JOIN q ON q.stage = f.stage AND q.horizon = f.horizon AND q.side = f.side),
i AS (SELECT *, unnest(['0.05', '0.5', '0.95']) AS alpha, unnest(q) AS shift FROM f)
SELECT stage, horizon, alpha, id, num_orders, exp(greatest(mean + shift, 0)) - 1 AS forecast FROM i"""


def _stump_regions(spark, sf_dir) -> DataFrame:
    return everything_forecast(stump_problem(spark, sf_dir), STUMP_SPECS, [FLAG])[1]


@query("stump_region_intervals", "panel", sql=f"""
SELECT stage, horizon, alpha, id, round(forecast, 5) AS forecast FROM ({_BY_SIDE})""")
def stump_region_intervals(spark, sf_dir) -> DataFrame:
    """Quantile forecasts by the leaf of a tree with two leaves."""
    return _stump_regions(spark, sf_dir).select("stage", "horizon", "alpha", "id", F.round("forecast", 5).alias("forecast"))


@query("stump_coverage", "panel", sql=f"""
SELECT stage, alpha, count(*) AS rows, count(*) FILTER (num_orders < round(forecast, 5)) AS below
FROM ({_BY_SIDE}) GROUP BY stage, alpha""")
def stump_coverage(spark, sf_dir) -> DataFrame:
    """How many targets lie below each quantile forecast, by stage."""
    truth = fixture.panel(spark, sf_dir)
    pairs = joins.align(truth, _stump_regions(spark, sf_dir).select("stage", "alpha", "id", "forecast"), SPEC.id, SPEC.target)
    below = F.count(F.when(F.col(scoring.ACTUAL) < F.round(scoring.FORECAST, 5), 1))
    return pairs.groupBy("stage", "alpha").agg(F.count(F.lit(1)).alias("rows"), below.alias("below"))


@query("stump_scores", "panel", sql=f"""
SELECT stage, alpha, count(*) AS rows, round(1 - avg((num_orders - forecast) ** 2) / var_pop(num_orders), 6) AS r2,
       round(sqrt(avg((num_orders - forecast) ** 2)), 6) AS rmse,
       round(sqrt(avg(ln((num_orders + 1) / (forecast + 1)) ** 2)), 6) AS rmsle
FROM ({_STUMP_ALL}) GROUP BY stage, alpha""")
def stump_scores(spark, sf_dir) -> DataFrame:
    """Score sheet by stage and alpha."""
    everything = _stump_everything(spark, sf_dir).select("stage", "alpha", "id", "forecast")
    sheet = scoring.score_sheet(joins.align(fixture.panel(spark, sf_dir), everything, SPEC.id, SPEC.target), ["stage", "alpha"])
    return sheet.select("stage", "alpha", "rows", *[F.round(c, 6).alias(c) for c in ("r2", "rmse", "rmsle")])


@query("stump_cv", "foldrows", sql="""
SELECT CAST(count(*) AS BIGINT) AS rows, round(1 - var_pop(m.mean - ln(f.num_orders + 1)) / var_pop(ln(f.num_orders + 1)), 6) AS score
FROM foldrows f JOIN (SELECT fold, homepage_featured, avg(ln(num_orders + 1)) AS mean FROM foldrows WHERE role = 'train' GROUP BY ALL) m
  USING (fold, homepage_featured) WHERE role = 'test'""")
def stump_cv(spark, sf_dir) -> DataFrame:
    """Cross-validation score of the model whose answer SQL knows."""
    p = stump_problem(spark, sf_dir)
    found = validation.cross_validate(p, [FLAG], FOLDS, refit=False)
    tested = time_slice(p.rows, SPEC.time, BOUNDS.test_time - FOLDS * BOUNDS.tstep, BOUNDS.test_time).count()
    return report(spark, rows=[tested], score=[round(found.score, 6)])


@query("count_model_means", "panel", sql="""
SELECT homepage_featured, round(avg(num_orders), 2) AS forecast FROM panel WHERE week <= 63 GROUP BY homepage_featured""")
def count_model_means(spark, sf_dir) -> DataFrame:
    """A count model on one 0/1 column predicts the mean of each group."""
    rows = time_slice(fixture.panel(spark, sf_dir), SPEC.time, upto=BOUNDS.train_time)
    fitted = models.fit_poisson(rows, [FLAG], SPEC.target).predict(rows)
    return fitted.groupBy(FLAG).agg(F.round(F.avg("forecast"), 2).alias("forecast"))


@query("forecast_invariants", "panel", sql="""
SELECT stage, CAST(week - origin AS INT) AS horizon, count(*) AS rows, CAST(0 AS BIGINT) AS bad
FROM panel JOIN (VALUES ('test', 63), ('final', 73)) s(stage, origin) ON week > origin AND week <= origin + 10 GROUP BY ALL""")
def forecast_invariants(spark, sf_dir) -> DataFrame:
    """Full models: every row of every horizon is forecast, none is missing or negative, quantiles are in order."""
    everything = _with_intervals(spark, sf_dir)
    alphas = ["l2", *[str(a) for a in ALPHAS]]
    wide = everything.groupBy("stage", "horizon", "id").pivot("alpha", alphas).agg(F.first("forecast"))
    low, mid, high = (F.col(f"`{a}`") for a in ALPHAS)
    sound = (F.col("l2") >= 0) & (low >= 0) & (low <= mid) & (mid <= high)
    bad = F.count(F.when(F.coalesce(sound, F.lit(False)), None).otherwise(1))
    return wide.groupBy("stage", "horizon").agg(F.count(F.lit(1)).alias("rows"), bad.alias("bad"))
