"""One model per forecast horizon, their forecasts, and intervals around them."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelwright.functions.columns import invert_log_target
from panelwright.operators.lags import LagSpec, add_lags, lag_frames
from panelwright.operators.quantiles import quantiles
from panelwright.operators.rows import time_slice
from panelwright.operators.scoring import FORECAST
from panelwright.operators.splits import Bounds
from panelwright.plans.boosting import Periods
from panelwright.plans.ledger import Ledger
from panelwright.plans.models import Fitted, fit_trees, model_path, stored_matrix
from panelwright.plans.validation import Problem, fits_at_once, run_together, validate
from panelwright.spec import PanelSpec
from panelwright.storage import materialize

LOG_FORECAST = "log_forecast"
POINT = "l2"
#: Errors that a region needs for quantiles of its own, unless told otherwise: one beyond a quantile of 0.05.
LEAST_ERRORS = 20


@dataclass
class Bank:
    """Models of one horizon: for the back-test (``test``) and for the future (``final``)."""

    spec: LagSpec | None
    test: Fitted
    final: Fitted | None


def earlier(problem: Problem) -> Problem:
    """The same problem one forecast length earlier; its back-test lies before the one of the problem."""
    b = problem.bounds
    return replace(problem, bounds=Bounds(b.start, b.train_time - b.tstep, b.train_time, b.test_time))


def fit_bank(
    problem: Problem, spec: LagSpec | None, features: Sequence[str], future: bool = True, root: str | None = None,
    done: Ledger | None = None,
) -> Bank:
    """Find the number of rounds on held-out parts, then refit for the back-test and, if asked, for the future.

    The back-test takes its rounds from a validation one forecast length earlier, so its errors are not those that
    stopped its own boosting. Refits see more periods than the validated model, so their rounds grow in proportion.
    Where no period is left to train such a validation on, boosting runs all its rounds. With a ``root`` models are saved
    below it, and what the ledger ``done`` says is there is loaded instead of fitted.
    """
    t, gap, spark = problem.time, spec.gap if spec else 0, problem.rows.sparkSession
    horizon = None if spec is None else spec.horizon
    parts = {"test": earlier(problem)} | ({"final": problem} if future else {})
    rows, weight = problem.fitted_on(features)

    def fit(part: Problem) -> Fitted:
        upto, seen = part.bounds.test_time, part.bounds.train_time - gap
        train = time_slice(rows, t, upto=upto)
        if seen < part.bounds.start:
            return fit_trees(train, features, problem.target, problem.params, matrix=problem.matrix, weight=weight, periods=Periods(upto))
        checked = validate(part, features, gap)
        rounds = max(1, int(checked.rounds * upto / seen))
        fitted = fit_trees(train, features, problem.target, problem.params, rounds=rounds, matrix=problem.matrix, weight=weight,
                           periods=Periods(upto))
        fitted.scores = checked.scores
        return fitted

    def saved(stage: str) -> Fitted:
        if root is None:
            return fit(parts[stage])
        path = model_path(root, stage, horizon, POINT)
        step = {"saved": stage, "horizon": horizon, "alpha": POINT, "features": list(features)}
        if done is not None and done.get(step):
            return Fitted.load(spark, path)
        fitted = fit(parts[stage])
        fitted.save(spark, path)
        if done is not None:
            done.put(step, True)  # only now is the model whole
        return fitted

    found = dict(zip(parts, run_together([lambda s=s: saved(s) for s in parts], len(parts)), strict=True))
    return Bank(spec, found["test"], found.get("final"))


def lag_problem(problem: Problem, panel: PanelSpec, specs: Sequence[LagSpec], features: Sequence[str] | None = None) -> Problem:
    """The problem with the lag columns of all horizons, computed in one shuffle and stored by period.

    Fits and forecasts filter on the period and open only its files. With ``features`` these and all lag columns are
    stored as one vector, which every fit of every horizon and stage shares, next to id, keys, period and target.
    """
    tstep = problem.bounds.tstep
    wide = add_lags(problem.rows, panel, specs, tstep)
    if features is None:
        return replace(problem, rows=materialize(wide, "all-lags", partition_by=problem.time))
    names = sorted({n for s in specs for n in lag_frames(s, tstep)})
    keep = [panel.id, *panel.keys, panel.time, problem.target]
    rows, matrix = stored_matrix(wide, [*features, *names], keep, partition_by=problem.time)
    return replace(problem, rows=rows, matrix=matrix)


def fit_horizons(
    problem: Problem, specs: Sequence[LagSpec], features: Sequence[str], root: str | None = None, future: bool = True
) -> list[Bank]:
    """Fit every horizon; ``problem`` holds all lag columns.

    With a ``root`` every finished model is saved below it and recorded there, so that a second run on the same data goes
    on where the first one stopped: it loads what is whole and fits the rest.
    """
    tstep = problem.bounds.tstep
    done = None if root is None else Ledger(problem.rows.sparkSession, f"{root}/finished")
    alone = replace(problem, parallelism=1)
    asked = [[*features, *lag_frames(s, tstep)] for s in specs]
    tasks = [lambda s=s, names=names: fit_bank(alone, s, names, future, root, done) for s, names in zip(specs, asked, strict=True)]
    most = max(map(len, asked), default=0)
    # A bank fits two stages together; where memory bounds the fits, it counts as two.
    together = fits_at_once(problem, most)
    if together < problem.parallelism and future:
        together = max(1, together // 2)
    return run_together(tasks, together)


def load_bank(spark: SparkSession, root: str, spec: LagSpec) -> Bank:
    load = lambda stage: Fitted.load(spark, model_path(root, stage, spec.horizon, POINT))
    return Bank(spec, load("test"), load("final"))


def forecast_horizons(
    problem: Problem, panel: PanelSpec, banks: Sequence[Bank], guides: dict[str, Sequence[Bank]] | None = None
) -> DataFrame:
    """Forecasts of both stages: each horizon's model predicts only the period that lies so far ahead.

    Columns: stage, horizon, id, keys, time, the target and the forecast in log form, the forecast back-transformed, and
    ``own_region``, the leaf of the forecasting model. ``guides`` gives for a stage the banks whose back-test errors its
    intervals come from; ``region`` is the leaf that their back-test model puts the row into, NULL for other stages.
    """
    parts = []
    guides = guides or {}
    for place, bank in enumerate(banks):
        for stage, fitted, back_test in (("test", bank.test, True), ("final", bank.final, False)):
            if fitted is None:
                continue
            ahead = problem.bounds.origin(back_test) + bank.spec.horizon
            rows = problem.rows.where(F.col(problem.time) == ahead)
            found = fitted.predict(rows, LOG_FORECAST, "own_region", problem.matrix)
            if stage in guides:
                found = guides[stage][place].test.predict(found, "_guided", "region", problem.matrix).drop("_guided")
            else:
                found = found.withColumn("region", F.lit(None).cast("int"))
            parts.append(
                found.select(
                    F.lit(stage).alias("stage"), F.lit(bank.spec.horizon).alias("horizon"),
                    panel.id, *panel.keys, panel.time, F.col(problem.target).alias("log_actual"), LOG_FORECAST,
                    invert_log_target(LOG_FORECAST).alias(FORECAST), "own_region", "region",
                )
            )
    return reduce(DataFrame.unionByName, parts)


def residual_quantiles(forecasts: DataFrame, alphas: Sequence[float], stage: str = "final") -> DataFrame:
    """Quantiles of the back-test errors by horizon, in log form, for use in one stage: (stage, horizon, alpha, shift).

    Errors must lie before the stage they serve: the back-test serves the final stage, and the back-test of the
    ``earlier`` problem serves the test stage.
    """
    errors = forecasts.where((F.col("stage") == "test") & F.col("log_actual").isNotNull()).select(
        "horizon", (F.col("log_actual") - F.col(LOG_FORECAST)).alias("residual")
    )
    names = {f"a{i}": a for i, a in enumerate(alphas)}
    found = quantiles(errors, ["horizon"], "residual", names)
    cells = [F.struct(F.lit(str(a)).alias("alpha"), F.col(n).alias("shift")) for n, a in names.items()]
    return found.select(F.lit(stage).alias("stage"), "horizon", F.inline(F.array(*cells)))


def interval_forecasts(forecasts: DataFrame, shifts: DataFrame, panel: PanelSpec) -> DataFrame:
    """Forecasts at every quantile: the point forecast moved by the error quantile of its stage and horizon.

    The back-transform is increasing, so quantiles keep their order. The shift table has one row per stage, horizon
    and quantile.
    """
    moved = forecasts.join(F.broadcast(shifts), ["stage", "horizon"])
    return moved.select(
        "stage", "horizon", "alpha", panel.id, *panel.keys, panel.time, "log_actual",
        invert_log_target(F.col(LOG_FORECAST) + F.col("shift")).alias(FORECAST),
    )


def region_quantiles(
    forecasts: DataFrame, alphas: Sequence[float], stage: str = "final", least: int = LEAST_ERRORS
) -> DataFrame:
    """Quantiles of the back-test errors by horizon and region, for one stage: (stage, horizon, region, shifts).

    A region is a leaf of the first tree of the model that made the errors, so rows whose demand varies more get wider
    bands. Regions with fewer than ``least`` errors have no row; the row with region NULL holds the quantiles of the whole
    horizon, for these and for leaves that no error reached. ``shifts`` is in the order of ``alphas``.
    """
    errors = forecasts.where((F.col("stage") == "test") & F.col("log_actual").isNotNull()).select(
        "horizon", F.col("own_region").alias("region"), (F.col("log_actual") - F.col(LOG_FORECAST)).alias("residual")
    )
    errors = materialize(errors, "errors")
    names = {f"a{i}": a for i, a in enumerate(alphas)}
    sizes = errors.groupBy("horizon", "region").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") >= least)
    # One row per leaf; there are at most horizons x leaves of one tree.
    local = quantiles(errors, ["horizon", "region"], "residual", names).join(F.broadcast(sizes.drop("_n")), ["horizon", "region"])
    whole = quantiles(errors, ["horizon"], "residual", names).withColumn("region", F.lit(None).cast("int"))
    shifts = F.array(*names).alias("shifts")
    return local.unionByName(whole).select(F.lit(stage).alias("stage"), "horizon", "region", shifts)


def region_intervals(forecasts: DataFrame, shifts: DataFrame, panel: PanelSpec, alphas: Sequence[float]) -> DataFrame:
    """Forecasts at every quantile: the point forecast moved by the error quantile of its stage, horizon and region.

    All quantiles of a row come from the same errors and the back-transform is increasing, so they keep their order. The
    shift tables have one row per stage, horizon and leaf.
    """
    shifts = materialize(shifts, "shifts")
    local = shifts.where(F.col("region").isNotNull()).withColumnRenamed("shifts", "_local")
    whole = shifts.where(F.col("region").isNull()).select("stage", "horizon", F.col("shifts").alias("_whole"))
    placed = forecasts.join(F.broadcast(whole), ["stage", "horizon"]).join(F.broadcast(local), ["stage", "horizon", "region"], "left")
    chosen = F.coalesce("_local", "_whole")
    cells = F.array(*[F.struct(F.lit(str(a)).alias("alpha"), chosen[i].alias("shift")) for i, a in enumerate(alphas)])
    moved = placed.select("*", F.inline(cells))
    return moved.select(
        "stage", "horizon", "alpha", panel.id, *panel.keys, panel.time, "log_actual",
        invert_log_target(F.col(LOG_FORECAST) + F.col("shift")).alias(FORECAST),
    )


def all_forecasts(forecasts: DataFrame, intervals: DataFrame) -> DataFrame:
    """Point and quantile forecasts as one long table with column ``alpha``."""
    point = forecasts.withColumn("alpha", F.lit(POINT)).select(*intervals.columns)
    return point.unionByName(intervals)


def compare_forecasts(rows: DataFrame, forecasts: DataFrame, baseline: DataFrame, series: DataFrame, panel: PanelSpec,
                      columns: Sequence[str], alphas: Sequence[float]) -> DataFrame:
    """Data, baseline, forecast and quantile band by period for the chosen series.

    ``series`` holds the keys of a few series, so the semi-joins cut everything else early.
    """
    keys = list(panel.keys)
    picked = rows.join(series, keys, "left_semi").select(panel.id, *keys, panel.time, *columns)
    base = baseline.join(series, keys, "left_semi").select("stage", panel.id, F.col(FORECAST).alias("baseline"))
    wanted = forecasts.join(series, keys, "left_semi")
    wide = wanted.groupBy("stage", panel.id).agg(
        F.max(F.when(F.col("alpha") == POINT, F.col(FORECAST))).alias(FORECAST),
        *[F.max(F.when(F.col("alpha") == str(a), F.col(FORECAST))).alias(f"q{round(100 * a):02d}") for a in alphas],
    )
    return picked.join(base.join(wide, ["stage", panel.id], "full"), panel.id, "left")
