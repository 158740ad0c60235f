"""Baselines, scores and residual reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalog.base import query
from panelwright.functions.columns import log_target
from panelwright.operators import scoring, splits
from panelwright.operators.quantiles import quantiles
from panelwright.sources import fixture

SPEC, BOUNDS = fixture.SPEC, fixture.BOUNDS
KEYS = list(SPEC.keys)


def scored(spark, sf_dir) -> DataFrame:
    """Future rows with the series-mean forecast and the truth, from one pass over the panel."""
    stage = {"final": (BOUNDS.test_time, BOUNDS.end)}
    return scoring.origin_baseline(fixture.panel(spark, sf_dir), SPEC, stage).drop("stage")


@query("forecast_baseline", "baseline", sql="SELECT id, week, center_id, meal_id, forecast FROM baseline")
def forecast_baseline(spark, sf_dir) -> DataFrame:
    return scored(spark, sf_dir).select("id", "week", *KEYS, scoring.FORECAST)


@query("score_rmse", "scored", sql="SELECT round(sqrt(avg((actual - forecast) * (actual - forecast))), 8) AS rmse FROM scored")
def score_rmse(spark, sf_dir) -> DataFrame:
    return scored(spark, sf_dir).agg(F.round(scoring.rmse(), 8).alias("rmse"))


@query("score_rmsle", "scored", sql="""
SELECT round(sqrt(avg(pow(ln((actual + 1) / (forecast + 1)), 2))), 8) AS rmsle FROM scored""")
def score_rmsle(spark, sf_dir) -> DataFrame:
    return scored(spark, sf_dir).agg(F.round(scoring.rmsle(), 8).alias("rmsle"))


_R2 = "1 - avg((actual - forecast) * (actual - forecast)) / var_pop(CASE WHEN forecast IS NOT NULL THEN actual END)"


@query("score_r2", "scored", sql=f"SELECT round({_R2}, 8) AS r2 FROM scored")
def score_r2(spark, sf_dir) -> DataFrame:
    return scored(spark, sf_dir).agg(F.round(scoring.r2(), 8).alias("r2"))


@query("score_r2_weighted", "scored", sql="""
SELECT round(1 - avg(w * pow(actual - forecast, 2)) / avg(w * pow(actual - m, 2)), 8) AS r2_weighted
FROM (SELECT *, meal_id AS w, (SELECT sum(actual * meal_id) / sum(meal_id) FROM scored) AS m FROM scored)
WHERE forecast IS NOT NULL""")
def score_r2_weighted(spark, sf_dir) -> DataFrame:
    rows = scored(spark, sf_dir).where(F.col(scoring.FORECAST).isNotNull())
    result = scoring.r2_weighted(rows, "meal_id")
    return result.select(F.round("r2_weighted", 8).alias("r2_weighted"))


@query("score_sheet", "scored", sql=f"""
SELECT 'final' AS stage, 'mean' AS alpha, CAST(count(*) AS BIGINT) AS rows, round({_R2}, 8) AS r2,
       round(sqrt(avg(pow(actual - forecast, 2))), 8) AS rmse, round(sqrt(avg(pow(ln((actual + 1) / (forecast + 1)), 2))), 8) AS rmsle
FROM scored""")
def score_sheet(spark, sf_dir) -> DataFrame:
    rows = scored(spark, sf_dir).withColumns({"stage": F.lit("final"), "alpha": F.lit("mean")})
    sheet = scoring.score_sheet(rows, ["stage", "alpha"])
    return sheet.withColumns({c: F.round(c, 8) for c in ("r2", "rmse", "rmsle")})


def cv_rows(spark, sf_dir) -> DataFrame:
    """Out-of-fold forecasts by the series mean of each fold's training part."""
    folds = splits.causal_folds(fixture.history(spark, sf_dir), SPEC.time, 5, BOUNDS.tstep, BOUNDS.test_time)
    means = folds.where(F.col("role") == "train").groupBy("fold", *KEYS).agg(F.avg(SPEC.target).alias(scoring.FORECAST))
    tests = folds.where(F.col("role") == "test").select("fold", *KEYS, "id", F.col(SPEC.target).cast("double").alias(scoring.ACTUAL))
    return tests.join(means, ["fold", *KEYS])


@query("cv_score", "cvrows", sql="""
SELECT CAST(count(*) AS BIGINT) AS rows, round(1 - var_pop(forecast - actual) / var_pop(actual), 8) AS score FROM cvrows""")
def cv_score(spark, sf_dir) -> DataFrame:
    return scoring.cv_score(cv_rows(spark, sf_dir)).withColumn("score", F.round("score", 8))


@query("cv_score_spread", "cvrows", sql="""
SELECT round(avg(mse), 8) AS mean_fold_error, round(stddev_pop(mse) / (SELECT var_pop(actual) FROM cvrows) / sqrt(4.0), 8) AS score_std
FROM (SELECT fold, avg(pow(actual - forecast, 2)) AS mse FROM cvrows GROUP BY fold)""")
def cv_score_spread(spark, sf_dir) -> DataFrame:
    spread = scoring.cv_score_spread(cv_rows(spark, sf_dir), 5)
    return spread.select(F.round("mean_fold_error", 8).alias("mean_fold_error"), F.round("score_std", 8).alias("score_std"))


@query("residuals_by_time", "scored", sql=f"""
SELECT week, CAST(count(*) AS BIGINT) AS rows, round(avg(forecast), 8) AS mean_forecast, round(avg(abs(forecast - actual)), 8) AS mean_error,
       round(stddev_pop(abs(forecast - actual)), 8) AS std_error, round({_R2}, 8) AS r2, round(median(abs(forecast - actual)), 8) AS median_error
FROM scored GROUP BY week""")
def residuals_by_time(spark, sf_dir) -> DataFrame:
    report = scoring.residuals_by_time(scored(spark, sf_dir), SPEC.time)
    return report.withColumns({c: F.round(c, 8) for c in report.columns if c not in (SPEC.time, "rows")})


@query("worst_residuals", "scored", sql="""
SELECT week, id, actual, round(forecast, 8) AS forecast, round(error, 8) AS error, CAST(place AS INT) AS place FROM (
  SELECT *, abs(forecast - actual) AS error, row_number() OVER (PARTITION BY week ORDER BY abs(forecast - actual) DESC, id) AS place
  FROM scored WHERE forecast IS NOT NULL) WHERE place <= 3""")
def worst_residuals(spark, sf_dir) -> DataFrame:
    worst = scoring.worst_residuals(scored(spark, sf_dir), SPEC.time, SPEC.id)
    return worst.select("week", "id", "actual", F.round("forecast", 8).alias("forecast"), F.round("error", 8).alias("error"), "place")


@query("residual_quantiles", "panel", sql="""
SELECT horizon, round(quantile_cont(r, 0.05), 8) AS q05, round(quantile_cont(r, 0.5), 8) AS q50, round(quantile_cont(r, 0.95), 8) AS q95
FROM (SELECT p.week - 63 AS horizon, ln(p.num_orders + 1) - ln(m.mean + 1) AS r
      FROM panel p JOIN (SELECT center_id, meal_id, avg(num_orders) AS mean FROM panel WHERE week <= 63 GROUP BY ALL) m
        USING (center_id, meal_id) WHERE p.week > 63 AND p.week <= 73) GROUP BY horizon""")
def residual_quantiles(spark, sf_dir) -> DataFrame:
    roles = splits.gap_roles(fixture.panel(spark, sf_dir), SPEC.time, BOUNDS, gap=0)
    train, test = (roles.where(F.col("role") == r).drop("role") for r in ("train", "test"))
    rows = scoring.mean_baseline(train, test, KEYS, SPEC.target)
    errors = rows.select(
        (F.col("week") - BOUNDS.train_time).alias("horizon"),
        (log_target(SPEC.target) - log_target(scoring.FORECAST)).alias("residual"),
    )
    found = quantiles(errors, ["horizon"], "residual", {"q05": 0.05, "q50": 0.5, "q95": 0.95})
    return found.select("horizon", *[F.round(q, 8).alias(q) for q in ("q05", "q50", "q95")])
