"""Scores of forecasts against truth. Inputs pair ``actual`` with ``forecast``; see ``joins.align``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelwright.operators.quantiles import quantiles
from panelwright.spec import PanelSpec
from panelwright.storage import materialize

ACTUAL, FORECAST = "actual", "forecast"


def _pair(actual: str, forecast: str) -> tuple[Column, Column]:
    return F.col(actual).cast("double"), F.col(forecast).cast("double")


def rmse(actual: str = ACTUAL, forecast: str = FORECAST) -> Column:
    y, p = _pair(actual, forecast)
    return F.sqrt(F.avg((y - p) * (y - p)))


def rmsle(actual: str = ACTUAL, forecast: str = FORECAST) -> Column:
    y, p = _pair(actual, forecast)
    gap = F.ln((y + 1) / (p + 1))
    return F.sqrt(F.avg(gap * gap))


def r2(actual: str = ACTUAL, forecast: str = FORECAST) -> Column:
    """1 - mean squared error / variance of the target; NULL for a constant target."""
    y, p = _pair(actual, forecast)
    return 1 - F.try_divide(F.avg((y - p) * (y - p)), F.var_pop(F.when(p.isNotNull(), y)))


def variance_score(actual: str = ACTUAL, forecast: str = FORECAST) -> Column:
    """1 - variance of the error / variance of the target, both over all rows together; a constant bias is free."""
    y, p = _pair(actual, forecast)
    return 1 - F.try_divide(F.var_pop(p - y), F.var_pop(y))


def r2_weighted(df: DataFrame, weight: str, by: Sequence[str] = ()) -> DataFrame:
    """R2 with weights, by group, in one aggregation.

    The spread around the weighted mean is that around the group's plain mean less the weighted shift between the two,
    which keeps precision for large targets. Rows without target, forecast or weight count in neither part.
    """
    y, p = _pair(ACTUAL, FORECAST)
    w = F.col(weight).cast("double")
    valid = y.isNotNull() & p.isNotNull() & w.isNotNull()
    rows = materialize(df.select(*by, F.when(valid, y).alias("_y"), F.when(valid, p).alias("_p"), F.when(valid, w).alias("_w")), "weighted")
    pilot = rows.groupBy(*by).agg(F.avg("_y").alias("_pilot"))
    rows = rows.join(pilot, list(by)) if by else rows.crossJoin(F.broadcast(pilot))  # the pilot is one row
    error, off, weighed = F.col("_y") - F.col("_p"), F.col("_y") - F.col("_pilot"), F.col("_w")
    total = F.sum(weighed)
    spread = F.sum(weighed * off * off) - F.try_divide(F.sum(weighed * off) * F.sum(weighed * off), total)
    return rows.groupBy(*by).agg((1 - F.try_divide(F.sum(weighed * error * error), spread)).alias("r2_weighted"))


def score_sheet(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """Rows, R2, RMSE and RMSLE for every group, such as stage and alpha."""
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("rows"), r2().alias("r2"), rmse().alias("rmse"), rmsle().alias("rmsle")
    )


def cv_score(df: DataFrame) -> DataFrame:
    """Score of the pooled out-of-fold forecasts."""
    return df.agg(F.count(F.lit(1)).alias("rows"), variance_score().alias("score"))


def cv_score_spread(df: DataFrame, nfold: int, fold: str = "fold") -> DataFrame:
    """Standard error of the fold errors, relative to the variance of the target.

    Fold totals are enough for both: squared errors give each fold's error, and counts, means and variances of the
    folds combine to the variance over all rows.
    """
    y, p = _pair(ACTUAL, FORECAST)
    folds = df.groupBy(fold).agg(
        F.avg((y - p) * (y - p)).alias("_mse"),
        F.count(y).cast("double").alias("_n"),
        F.avg(y).alias("_mean"),
        F.var_pop(y).alias("_var"),
    )
    n, mean = F.sum("_n"), F.col("_mean")
    within = F.sum(F.col("_n") * F.col("_var")) / n
    overall = F.sum(F.col("_n") * mean) / n
    between = F.sum(F.col("_n") * mean * mean) / n - overall * overall
    return folds.agg(
        F.avg("_mse").alias("mean_fold_error"),
        (F.try_divide(F.stddev_pop("_mse"), within + between) / F.sqrt(F.lit(nfold - 1.0))).alias("score_std"),
    )


def residuals_by_time(df: DataFrame, time: str) -> DataFrame:
    """Per period: rows, mean forecast and, where the target is known, statistics of the absolute error and R2."""
    y, p = _pair(ACTUAL, FORECAST)
    # Stored, so that the pairs are made once for the plain statistics and the medians.
    rows = materialize(df.select(time, ACTUAL, FORECAST, F.abs(p - y).alias("_error")), "errors")
    simple = rows.groupBy(time).agg(
        F.count(F.lit(1)).alias("rows"),
        F.avg(FORECAST).alias("mean_forecast"),
        F.avg("_error").alias("mean_error"),
        F.stddev_pop("_error").alias("std_error"),
        r2().alias("r2"),
    )
    medians = quantiles(rows, [time], "_error", {"median_error": 0.5})
    return simple.join(medians, time, "left")


def worst_residuals(df: DataFrame, time: str, id_col: str, n: int = 3) -> DataFrame:
    """The ``n`` largest absolute errors of every period; Spark keeps only ``n`` rows a period before the shuffle."""
    y, p = _pair(ACTUAL, FORECAST)
    w = Window.partitionBy(time).orderBy(F.desc("error"), F.asc(id_col))
    ranked = df.withColumn("error", F.abs(p - y)).where(F.col("error").isNotNull())
    return ranked.withColumn("place", F.row_number().over(w)).where(F.col("place") <= n)


def mean_baseline(history: DataFrame, rows: DataFrame, keys: Sequence[str], target: str, out: str = FORECAST) -> DataFrame:
    """Forecast the mean known target of the series; NULL for a series without history."""
    means = history.groupBy(*keys).agg(F.avg(target).alias(out))
    return rows.join(means, list(keys), "left").select(*rows.columns, out)


def origin_baseline(
    rows: DataFrame, panel: PanelSpec, stages: dict[str, tuple[int, int]], columns: Sequence[str] = (), out: str = FORECAST
) -> DataFrame:
    """Series means known at the origin of each stage, for the rows that the stage forecasts, from one pass over ``rows``.

    ``stages`` maps a name to (origin, last period). Returns stage, id, keys, time, ``columns``, the target as ``actual``,
    and the mean target of the series up to the origin, which is NULL for a series without history or without a key.
    A row appears once for every stage that forecasts it. Where the panel bounds the rows of a series, the sums carry the
    later rows of their series along; otherwise a series may be too long for that, and slim rows, stored once, are joined.
    """
    keys, t, y = list(panel.keys), F.col(panel.time), F.col(panel.target)
    kept = list(dict.fromkeys([panel.id, panel.time, *columns]))
    first, last = min(o for o, _ in stages.values()), max(e for _, e in stages.values())
    ahead = (t > first) & (t <= last)
    slim = rows.select(*dict.fromkeys([*keys, *kept, panel.target])).where(t <= last)
    means = {name: f"_mean_{i}" for i, name in enumerate(stages)}
    sums = [F.avg(F.when(t <= origin, y)).alias(means[name]) for name, (origin, _) in stages.items()]
    if panel.max_rows is None:
        slim = materialize(slim, "baseline-rows")
        wide = slim.where(ahead).join(slim.groupBy(*keys).agg(*sums), keys, "left")
    else:
        later = F.collect_list(F.when(ahead, F.struct(*kept, y.alias("_y")))).alias("_later")
        wide = slim.groupBy(*keys).agg(*sums, later).select(*keys, *means.values(), F.inline("_later"))
        wide = wide.withColumnRenamed("_y", panel.target)
    keyed = F.lit(True)
    for k in keys:
        keyed = keyed & F.col(k).isNotNull()
    parts = []
    for name, (origin, end) in stages.items():
        mine = F.when(keyed, F.col(means[name])).alias(out)
        parts.append(F.when((t > origin) & (t <= end), F.struct(F.lit(name).alias("stage"), mine)))
    unfolded = F.inline(F.filter(F.array(*parts), lambda p: p.isNotNull()))
    found = wide.select(*wide.columns, unfolded)
    return found.select("stage", panel.id, *keys, panel.time, *[c for c in kept if c not in (panel.id, panel.time, *keys)], y.alias(ACTUAL), out)
