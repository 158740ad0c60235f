"""Models whose answers SQL knows: stumps on 0/1 columns, for early stopping, scaled refits, ranking, search and importances."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalog.base import query
from catalog.models import (
    _STUMP_ALL, FLAG, FOLDS, KEYS, SPEC, TRIALS, _stage_baseline, _stump_everything, report, stump_problem,
)
from panelwright.operators.lags import LagSpec
from panelwright.plans import forecast, models, search, selection, validation
from panelwright.sources import fixture, writers
from panelwright.storage import materialize, new_path

FLAGS = ("homepage_featured", "emailer_for_promotion")
#: A second round of this learning rate moves all the way to the mean residual, as the loss has twice its gradient.
BOOSTED = models.TreeParams(rounds=3, learning_rate=0.5, depth=1, min_rows=1, tolerance=0.001)
#: The last ten known months turn the third effect around, so the third round that helped before harms there.
_PLANTED = """8 * (center_id % 2) + 4 * (meal_id % 2) + CASE WHEN week > 63 THEN -2 ELSE 2 END * ((center_id // 2) % 2)"""
_ROUNDS = f"""
WITH s(stage, horizon, seen, lo, hi) AS (VALUES ('final', 1, 63, 63, 73), ('final', 10, 54, 63, 73), ('test', 1, 53, 53, 63), ('test', 10, 44, 53, 63)),
d AS (SELECT s.*, week, center_id % 2 AS f1, meal_id % 2 AS f2, (center_id // 2) % 2 AS f3, CAST({_PLANTED} AS DOUBLE) AS y
      FROM panel JOIN s ON week <= seen OR (week > lo AND week <= hi)),
d1 AS (SELECT d.*, v AS p1 FROM d JOIN (SELECT stage, horizon, f1, avg(y) AS v FROM d WHERE week <= seen GROUP BY ALL) USING (stage, horizon, f1)),
d2 AS (SELECT d1.*, p1 + v AS p2 FROM d1 JOIN (SELECT stage, horizon, f2, avg(y - p1) AS v FROM d1 WHERE week <= seen GROUP BY ALL) USING (stage, horizon, f2)),
d3 AS (SELECT d2.*, p2 + v AS p3 FROM d2 JOIN (SELECT stage, horizon, f3, avg(y - p2) AS v FROM d2 WHERE week <= seen GROUP BY ALL) USING (stage, horizon, f3)),
e AS (SELECT stage, horizon, any_value(seen) AS seen, any_value(hi) AS hi, avg((y - p1) ** 2) AS e1, avg((y - p2) ** 2) AS e2, avg((y - p3) ** 2) AS e3
      FROM d3 WHERE week > lo GROUP BY stage, horizon),
r AS (SELECT *, CASE WHEN e1 - e2 < 0.001 * greatest(e2, 0.01) THEN 1 WHEN e2 - e3 < 0.001 * greatest(e3, 0.01) THEN 2 ELSE 3 END AS best FROM e),
n AS (SELECT count(*) AS known, count(*) FILTER (week > 53) AS tested FROM panel WHERE week <= 73)
SELECT stage, CAST(horizon AS BIGINT) AS horizon, CAST(best AS BIGINT) AS best, CAST(greatest(1, floor(best * hi / seen)) AS BIGINT) AS refit FROM r
UNION ALL SELECT 'cv', 1, CAST(round_even(avg(best), 0) AS BIGINT), CAST(floor(round_even(avg(best), 0) * any_value(known) / (any_value(known) - 0.5 * any_value(tested))) AS BIGINT)
FROM r, n WHERE horizon = 1"""


@query("boosting_rounds", "panel", sql=f"SELECT * FROM ({_ROUNDS})")
def boosting_rounds(spark, sf_dir) -> DataFrame:
    """The round at which boosting stops on held-out rows, and the rounds of refits on more periods, for effects added one by one.

    Every round of this model takes one column, so SQL can follow it.
    """
    rows = fixture.with_future(spark, sf_dir).selectExpr(
        "id", *KEYS, "week", "cast(center_id % 2 as int) AS f1", "cast(meal_id % 2 as int) AS f2", "cast((center_id div 2) % 2 as int) AS f3",
        f"CASE WHEN num_orders IS NOT NULL THEN cast({_PLANTED.replace('//', 'div')} as double) END AS y",
    )
    names, found = ["f1", "f2", "f3"], []
    p = validation.counted(validation.Problem(materialize(rows, "planted"), SPEC.time, "y", fixture.BOUNDS, BOOSTED), names)
    for h in (1, 10):
        bank = forecast.fit_bank(p, LagSpec(-h, -h - 1, -h, 0.0), names)
        for stage, part, refit in (("final", p, bank.final), ("test", forecast.earlier(p), bank.test)):
            found.append((stage, h, validation.validate(part, names, h - 1).rounds, refit.rounds))
    scored = validation.cross_validate(p, names, 2)
    best = validation.cross_validate(p, names, 2, refit=False).rounds
    found.append(("cv", 1, best, scored.rounds))
    stage, horizon, best, refit = zip(*found, strict=True)
    return report(spark, stage=list(stage), horizon=list(horizon), best=list(best), refit=list(refit))


def _cv_sql(flag: str, split: str = "true") -> str:
    """Score of a stump on one flag over the folds of the history; where ``split`` fails for a fold, the mean of all its rows."""
    return f"""
SELECT round(1 - var_pop(forecast - y) / var_pop(y), 6) AS score FROM (
  SELECT ln(f.num_orders + 1) AS y, CASE WHEN {split} THEN m.mean ELSE a.mean END AS forecast
  FROM foldrows f JOIN (SELECT fold, {flag}, avg(ln(num_orders + 1)) AS mean FROM foldrows WHERE role = 'train' GROUP BY ALL) m USING (fold, {flag})
  JOIN (SELECT fold, avg(ln(num_orders + 1)) AS mean, least(count(*) FILTER ({flag} = 0), count(*) FILTER ({flag} = 1)) AS least_side
        FROM foldrows WHERE role = 'train' GROUP BY fold) a USING (fold) WHERE role = 'test')"""


@query("rank_flags", "foldrows", sql=f"""
SELECT CAST(row_number() OVER (ORDER BY score DESC) AS BIGINT) AS place, name, score
FROM ({' UNION ALL '.join(f"SELECT '{f}' AS name, score FROM ({_cv_sql(f)})" for f in FLAGS)})""")
def rank_flags(spark, sf_dir) -> DataFrame:
    """Single-step ranking of two groups of one 0/1 column each."""
    ranking = selection.rank_groups(validation.CvScores(stump_problem(spark, sf_dir), FOLDS), [], [[f] for f in FLAGS], 1)
    return report(spark, place=[1, 2], name=[g[0] for g, _ in ranking.ranked], score=[round(s, 6) for _, s in ranking.ranked])


_CHOSEN = "CASE WHEN homepage_left <= emailer_left THEN {0} ELSE {1} END"
_BOTH = f"""
SELECT round(1 - var_pop(forecast - y) / var_pop(y), 6) AS score FROM (
  SELECT ln(f.num_orders + 1) AS y, {_CHOSEN.format("h.mean", "e.mean")} AS forecast FROM foldrows f
  JOIN (SELECT fold, homepage_featured, avg(ln(num_orders + 1)) AS mean FROM foldrows WHERE role = 'train' GROUP BY ALL) h USING (fold, homepage_featured)
  JOIN (SELECT fold, emailer_for_promotion, avg(ln(num_orders + 1)) AS mean FROM foldrows WHERE role = 'train' GROUP BY ALL) e USING (fold, emailer_for_promotion)
  JOIN (SELECT fold, sum(n * v) AS homepage_left FROM (SELECT fold, count(*) AS n, var_pop(ln(num_orders + 1)) AS v FROM foldrows WHERE role = 'train' GROUP BY fold, homepage_featured) GROUP BY fold) USING (fold)
  JOIN (SELECT fold, sum(n * v) AS emailer_left FROM (SELECT fold, count(*) AS n, var_pop(ln(num_orders + 1)) AS v FROM foldrows WHERE role = 'train' GROUP BY fold, emailer_for_promotion) GROUP BY fold) USING (fold)
  WHERE role = 'test')"""


@query("stump_selection", "foldrows", sql=f"""
SELECT CASE WHEN both_s <= e THEN 'emailer_for_promotion' WHEN greatest(h, e) > both_s THEN CASE WHEN h >= e THEN 'homepage_featured' ELSE 'emailer_for_promotion' END
            ELSE 'emailer_for_promotion homepage_featured' END AS chosen,
       CASE WHEN both_s <= e THEN e ELSE greatest(h, e, both_s) END AS score
FROM (SELECT ({_cv_sql("homepage_featured")}) AS h, ({_cv_sql("emailer_for_promotion")}) AS e, ({_BOTH}) AS both_s)""")
def stump_selection(spark, sf_dir) -> DataFrame:
    """Forward and backward steps over two groups, from one of them.

    A stump on both columns takes the one that leaves less variance in a fold's training part.
    """
    scores = validation.CvScores(stump_problem(spark, sf_dir), FOLDS)
    found = selection.forward_backward(scores, [FLAGS[1]], [[f] for f in FLAGS], [1.0, 2.0], parallelism=2)
    return report(spark, chosen=[" ".join(sorted(found.features))], score=[round(found.score, 6)])


_DRAWN = [t["min_rows"] for t in search.draw_trials({"min_rows": search.Range(*search.MIN_ROWS, whole=True, log=True)}, TRIALS, 1)]


@query("param_trials", "foldrows", sql=" UNION ALL ".join(
    f"SELECT CAST({v} AS BIGINT) AS min_rows, score FROM ({_cv_sql(FLAG, f'least_side >= {v}')})" for v in _DRAWN))
def param_trials(spark, sf_dir) -> DataFrame:
    """Search of the least rows of a leaf: a stump whose smaller side has fewer rows does not split."""
    trials = search.search_params(stump_problem(spark, sf_dir), [FLAG], FOLDS, TRIALS, "min_rows")
    return report(spark, min_rows=[t.values["min_rows"] for t in trials], score=[round(t.score, 6) for t in trials])


_SPREAD = " UNION ALL ".join(
    f"SELECT '{f}' AS feature, sum(n * v) AS left_over FROM (SELECT count(*) AS n, var_pop(ln(num_orders + 1)) AS v FROM panel WHERE week <= 63 GROUP BY {f})"
    for f in FLAGS
)


@query("stump_importance", "panel", sql=f"""
SELECT feature, CAST(place = 1 AS DOUBLE) AS importance, CAST(place = 1 AS BIGINT) AS splits, place = 1 AS top
FROM (SELECT feature, row_number() OVER (ORDER BY left_over) AS place FROM ({_SPREAD}))""")
def stump_importance(spark, sf_dir) -> DataFrame:
    """Gain, split counts and the most important feature of a stump: the column that leaves the least variance has all of it."""
    fitted = validation.validate(stump_problem(spark, sf_dir), FLAGS)
    gains, splits = fitted.importances(), fitted.split_counts(spark)
    top = set(selection.most_important(gains, 1))
    return report(spark, feature=list(FLAGS), importance=[gains[f] for f in FLAGS],
                  splits=pa.array([splits[f] for f in FLAGS], pa.int64()), top=[f in top for f in FLAGS])


@query("forecast_files", "panel", sql=f"""
SELECT id, num_orders, round(forecast, 5) AS forecast FROM ({_STUMP_ALL}) WHERE stage = 'final' AND alpha = '0.95'""")
def forecast_files(spark, sf_dir) -> DataFrame:
    """Forecasts of all stages and quantiles stored as files; the files of one quantile of one stage read again."""
    path = new_path(spark, "forecasts")
    writers.write_forecasts(_stump_everything(spark, sf_dir), path)
    read = writers.read_forecasts(spark, path, "final", "0.95")
    truth = fixture.panel(spark, sf_dir).select("id", "num_orders")
    return read.join(truth, "id").select("id", "num_orders", F.round("forecast", 5).alias("forecast"))


@query("stump_compare", "panel", sql=f"""
SELECT p.id, p.center_id, p.meal_id, p.week, p.checkout_price, CASE WHEN p.week <= 73 THEN p.num_orders END AS num_orders, w.stage,
       round(b.baseline, 5) AS baseline, round(w.forecast, 5) AS forecast, round(w.q05, 5) AS q05, round(w.q50, 5) AS q50, round(w.q95, 5) AS q95
FROM panel p LEFT JOIN (
  SELECT stage, id, max(forecast) FILTER (alpha = 'l2') AS forecast, max(forecast) FILTER (alpha = '0.05') AS q05,
         max(forecast) FILTER (alpha = '0.5') AS q50, max(forecast) FILTER (alpha = '0.95') AS q95 FROM ({_STUMP_ALL}) GROUP BY stage, id) w ON w.id = p.id
LEFT JOIN (SELECT s.stage, f.id, avg(h.num_orders) AS baseline FROM panel f JOIN (VALUES ('test', 63), ('final', 73)) s(stage, origin) ON f.week > origin AND f.week <= origin + 10
  LEFT JOIN panel h ON h.center_id = f.center_id AND h.meal_id = f.meal_id AND h.week <= s.origin GROUP BY s.stage, f.id) b ON b.id = p.id AND b.stage = w.stage""")
def stump_compare(spark, sf_dir) -> DataFrame:
    """The comparison table of data, baseline, forecast and quantile band, for all series and a model that SQL knows."""
    rows = fixture.with_future(spark, sf_dir)
    series = rows.select(*KEYS).distinct()
    table = forecast.compare_forecasts(rows, _stump_everything(spark, sf_dir), _stage_baseline(spark, sf_dir), series, SPEC,
                                       ["checkout_price", "num_orders"], (0.05, 0.5, 0.95))
    rounded = [F.round(c, 5).alias(c) for c in ("baseline", "forecast", "q05", "q50", "q95")]
    return table.select("id", *KEYS, "week", "checkout_price", "num_orders", "stage", *rounded)
