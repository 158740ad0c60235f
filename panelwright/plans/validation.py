"""Causal cross-validation and held-out validation of tree models."""

from __future__ import annotations

import math
import threading
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from contextvars import copy_context
from dataclasses import asdict, dataclass, field, replace
from functools import partial
from multiprocessing.pool import ThreadPool
from typing import Any

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelwright.operators.rows import time_slice
from panelwright.operators.scoring import FORECAST, variance_score
from panelwright.operators.splits import Bounds, fold_starts, gap_roles
from panelwright.plans.boosting import FITS_TOGETHER, GATHERING, Blocks, Gathering, Moments, Periods, away
from panelwright.plans.ledger import Ledger
from panelwright.plans.models import COUNT, WHOLE_ROWS, Fitted, Grown, Matrix, TreeParams, count_equal, fit_trees, r2_by, unraced

#: A stored vector of up to so many bytes is kept in the executors' memory while many fits read it, and the fits that run
#: together keep about so many bytes of binned rows beside it.
MEMORY_BYTES = 4 << 30
#: Bytes that a fit keeps for a row besides four for each feature.
ROW_BYTES = 100


def run_together(tasks: Sequence[Callable[[], Any]], parallelism: int) -> list[Any]:
    """Run driver-side steps that each launch Spark jobs; their jobs share the executors.

    Fits on coded rows that the steps ask for are gathered until every running step waits for one, and grow together.
    """
    if parallelism <= 1 or len(tasks) <= 1:
        return [unraced(task) for task in tasks]
    outer = GATHERING.get()
    gathering, workers = outer or Gathering(), min(parallelism, len(tasks))
    waiting, lock = [len(tasks) - workers], threading.Lock()

    def counted(task: Callable[[], Any]) -> Any:
        try:
            return unraced(task)
        finally:
            with lock:
                last, waiting[0] = waiting[0] <= 0, waiting[0] - 1
            if last:  # no further step takes the place of this one
                gathering.count(-1)

    token = GATHERING.set(gathering)
    try:
        inherit = inheritable_thread_target(SparkSession.active())
        inside = [partial(copy_context().run, inherit(task)) for task in tasks]  # a thread keeps the scratch block it starts in
    finally:
        GATHERING.reset(token)
    gathering.count(workers)
    with away(outer), ThreadPool(workers) as pool:
        return pool.map(counted, inside, chunksize=1)


@dataclass(frozen=True)
class Problem:
    """What to predict from which rows: ``target`` may be the logarithm of the demand.

    With ``matrix`` the rows hold the features as one vector (``models.stored_matrix``), else as columns. ``ledger`` keeps
    the scores and finished steps of searches; without one, every search keeps its own. ``counts`` holds the rows with a
    target, equal ones once with their number, for fits on columns of few values; see ``counted``.
    """

    rows: DataFrame
    time: str
    target: str
    bounds: Bounds
    params: TreeParams
    parallelism: int = 4
    matrix: Matrix | None = None
    ledger: Ledger | None = None
    counts: DataFrame | None = None

    def fitted_on(self, features: Sequence[str]) -> tuple[DataFrame, str | None]:
        """The rows that fits and scores on ``features`` read, and the column of how many rows each stands for, if any."""
        if self.counts is not None and self.matrix is None and set(features) <= set(self.counts.columns):
            return self.counts, COUNT
        return self.rows, None


def counted(problem: Problem, features: Sequence[str]) -> Problem:
    """The problem with equal rows counted, so that no fit on ``features`` reads them one by one.

    Features of many different values leave the problem as it is.
    """
    return replace(problem, counts=count_equal(problem.rows, features, problem.time, problem.target))


def fits_at_once(problem: Problem, features: int) -> int:
    """How many fits of so many features run together: at most the problem's ``parallelism``.

    Every fit keeps its binned rows until it ends. More fits than fit into memory would read them from disk at every
    level of every tree, and two fits on many rows keep the executors busy already. Fits on coded rows keep none, and
    share more of their work the more of them run together.
    """
    if problem.matrix is not None and problem.matrix.blocks(problem.target) is not None:
        return FITS_TOGETHER
    size = None if problem.matrix is None else problem.matrix.size
    if size is None:
        return problem.parallelism
    rows = size / 8 / (len(problem.matrix.places) + 2)
    room = int(MEMORY_BYTES / max(1.0, rows * (4 * features + ROW_BYTES)))
    return min(problem.parallelism, max(2, room))


@contextmanager
def remembered(problem: Problem, few: int | None = None) -> Iterator[None]:
    """Keep the stored vector of a problem with the executors inside the block, for the many fits that read it.

    The vector is coded once, and the fits read the codes together (``boosting.Blocks``). Up to ``few`` rows, by default
    ``WHOLE_ROWS``, of which Spark's own trees see every value, each fit is one of theirs; it reads a vector of up to
    ``MEMORY_BYTES`` from memory, and a larger one from its files. What the block returns may read the rows still; they
    then come from the files again.
    """
    matrix = problem.matrix
    if matrix is None or matrix.rows is None:
        yield
        return
    coded = matrix.rows > (WHOLE_ROWS if few is None else few)
    kept = matrix.rows <= WHOLE_ROWS and matrix.size <= MEMORY_BYTES
    if coded:
        matrix.coded.insert(0, Blocks(problem.rows, matrix.column, problem.time, problem.target, matrix.rows))
    if kept:
        problem.rows.persist().count()  # filled once, before fits that start together ask for it
    try:
        yield
    finally:
        if kept:
            problem.rows.unpersist()
        if coded:
            matrix.coded.pop(0).close()


@dataclass
class CvResult:
    score: float
    score_std: float
    rounds: int
    importances: dict[str, float] = field(default_factory=dict)
    score_train: float | None = None
    score_test: float | None = None


def validate(problem: Problem, features: Sequence[str], gap: int = 0) -> Fitted:
    """Fit on the training part less a gap, stop early on the test part, and score both."""
    rows, weight = problem.fitted_on(features)
    roles = gap_roles(rows, problem.time, problem.bounds, gap, out="_role")
    marked = roles.withColumn("_held", F.col("_role") == "test")
    origin = problem.bounds.origin(True)
    periods = Periods(origin - gap, origin, problem.bounds.test_time)
    fitted = fit_trees(marked, features, problem.target, problem.params, held="_held", matrix=problem.matrix, weight=weight, periods=periods)
    if isinstance(fitted, Grown):
        fitted.scores = {"train": fitted.fit.train.r2, "test": fitted.fit.held.r2}
        return fitted
    scores = r2_by(fitted, roles, problem.target, "_role", problem.matrix, weight)
    fitted.scores = {role: scores.get(role) for role in ("train", "test")}
    return fitted


@dataclass(frozen=True)
class FoldFit:
    """One fold: rounds of its model, and counts, means and variances of targets and errors on its test part."""

    rounds: int
    rows: int
    mean: float
    variance: float
    error_mean: float
    error_variance: float

    @property
    def squared_error(self) -> float:
        return self.error_variance + self.error_mean**2


def fit_fold(problem: Problem, features: Sequence[str], start: int, gap: int) -> FoldFit:
    """Fit on the past of one test part, which begins after ``start``, and sum up its errors in one pass."""
    t, target = F.col(problem.time), problem.target
    wanted = (t <= start - gap) | ((t > start) & (t <= start + problem.bounds.tstep))
    source, weight = problem.fitted_on(features)
    rows = source.where(wanted & F.col(target).isNotNull()).withColumn("_held", t > start)
    if problem.matrix is not None and problem.matrix.parts is not None:
        rows = rows.coalesce(problem.matrix.parts)
    periods = Periods(start - gap, start, start + problem.bounds.tstep)
    fitted = fit_trees(rows, features, target, problem.params, held="_held", matrix=problem.matrix, weight=weight, periods=periods)
    if isinstance(fitted, Grown):
        return FoldFit(fitted.rounds, *_known_moments(fitted.fit.held))
    scored = fitted.predict(rows.where("_held"), FORECAST, matrix=problem.matrix)
    return FoldFit(fitted.rounds, *_moments(scored, target, weight))


def _known_moments(m: Moments) -> list[Any]:
    n = max(m.n, 1)
    return [m.n, m.mean, m.spread / n, m.error_mean, m.error_spread / n]


def _moments(scored: DataFrame, target: str, weight: str | None) -> list[Any]:
    """Number of rows, and means and variances of targets and errors, 0 without rows."""
    y, error = F.col(target).cast("double"), F.col(FORECAST) - F.col(target)
    if weight is None:
        found = scored.agg(F.count(F.lit(1)).alias("n"), F.avg(y), F.var_pop(y), F.avg(error), F.var_pop(error)).first()
        return [found["n"], *[0.0 if v is None else v for v in found[1:]]]
    w = F.col(weight)
    middle = scored.agg(F.sum(w), F.sum(w * y) / F.sum(w), F.sum(w * error) / F.sum(w)).first()
    if not middle[0]:
        return [0, 0.0, 0.0, 0.0, 0.0]
    # Around the means, so that a large offset costs no precision.
    spread = [F.sum(w * (v - F.lit(m)) * (v - F.lit(m))) / F.sum(w) for v, m in ((y, middle[1]), (error, middle[2]))]
    around = scored.agg(*spread).first()
    return [middle[0], middle[1], around[0], middle[2], around[1]]


def pooled_score(folds: Sequence[FoldFit]) -> CvResult:
    """Variance-form score of all out-of-fold forecasts together, and its standard error over the folds.

    Counts, means and variances of the folds combine to those over all rows, so no forecasts are kept.
    """
    n = sum(f.rows for f in folds)
    rounds = max(1, round(sum(f.rounds for f in folds) / len(folds)))

    def spread(mean: str, variance: str) -> float:
        middle = sum(f.rows * getattr(f, mean) for f in folds) / n
        return sum(f.rows * (getattr(f, variance) + (getattr(f, mean) - middle) ** 2) for f in folds) / n

    total = spread("mean", "variance") if n else 0.0
    if not total:
        return CvResult(float("nan"), float("nan"), rounds)
    errors = [f.squared_error for f in folds]
    middle = sum(errors) / len(errors)
    deviation = math.sqrt(sum((e - middle) ** 2 for e in errors) / len(errors))
    std = deviation / total / math.sqrt(len(folds) - 1) if len(folds) > 1 else None
    return CvResult(1 - spread("error_mean", "error_variance") / total, std, rounds)


def cross_validate(
    problem: Problem, features: Sequence[str], nfold: int, gap: int = 0, back_test: bool = False, refit: bool = True
) -> CvResult:
    """Fit one model per fold on the past of the fold, and score all out-of-fold forecasts together.

    With ``refit`` a model on all rows follows, with rounds scaled up to its larger training part; it gives the
    importances, the training score and, in a back-test, the test score.
    """
    b, t, target = problem.bounds, problem.time, problem.target
    last = b.train_time - gap if back_test else b.test_time
    tasks = [lambda s=s: fit_fold(problem, features, s, gap) for _, s in fold_starts(nfold, b.tstep, last)]
    folds = run_together(tasks, fits_at_once(problem, len(features)))
    result = pooled_score(folds)
    if not refit:
        return result
    rounds = result.rounds
    source, weight = problem.fitted_on(features)
    everything = time_slice(source, t, upto=last).where(F.col(target).isNotNull())
    if not back_test:
        blocks = None if problem.matrix is None else problem.matrix.blocks(target)
        if blocks is not None:
            known = blocks.count(last)
        else:
            known = everything.count() if weight is None else everything.agg(F.sum(weight)).first()[0]
        rounds = max(1, int(rounds * known / (known - 0.5 * sum(f.rows for f in folds))))
    final = fit_trees(everything, features, target, problem.params, rounds=rounds, matrix=problem.matrix, weight=weight, periods=Periods(last))
    result.rounds, result.importances = rounds, final.importances()
    if isinstance(final, Grown):
        result.score_train = final.fit.train.variance_score
    else:
        result.score_train = variance_of(final, everything, target, problem.matrix, weight)
    if back_test:
        result.score_test = variance_of(final, time_slice(source, t, b.train_time, b.test_time), target, problem.matrix, weight)
    return result


def variance_of(
    fitted: Fitted, rows: DataFrame, target: str, matrix: Matrix | None = None, weight: str | None = None
) -> float | None:
    """Variance-form score of a model on one set of rows."""
    scored = fitted.predict(rows.where(F.col(target).isNotNull()), matrix=matrix)
    if weight is not None:
        _, _, total, _, left = _moments(scored, target, weight)
        return 1 - left / total if total else None
    return scored.agg(variance_score(target, FORECAST).alias("score")).first()["score"]


class CvScores:
    """Cross-validation scores of sets of features, each set fitted once.

    A set is known by its sorted names, the gap, the folds and the model settings, whatever drew or asked for it: many lag
    settings have the same columns, and a selection comes back to sets it has left. Scores that a ledger with a folder
    holds are not fitted again by a later run either. All folds of all sets asked for together are fitted together.
    """

    def __init__(self, problem: Problem, nfold: int, gap: int = 0):
        self.problem, self.nfold, self.gap = problem, nfold, gap
        self.ledger = Ledger() if problem.ledger is None else problem.ledger

    def _key(self, features: Sequence[str], params: TreeParams) -> dict[str, Any]:
        b = self.problem.bounds
        return {"score": sorted(set(features)), "gap": self.gap, "folds": self.nfold, "params": asdict(params),
                "target": self.problem.target, "upto": b.test_time, "tstep": b.tstep}

    def many(self, sets: Sequence[Sequence[str]], params: Sequence[TreeParams] | None = None) -> list[CvResult]:
        """Scores of all sets, each with its model settings, if given; those not known yet are fitted."""
        asked = list(zip(sets, params or [self.problem.params] * len(sets), strict=True))
        missing = {}
        for names, settings in asked:
            key = self._key(names, settings)
            if self.ledger.get(key) is None:
                missing.setdefault((tuple(key["score"]), settings), key)
        b = self.problem.bounds
        starts = [s for _, s in fold_starts(self.nfold, b.tstep, b.test_time)]
        waiting = {one: [None] * len(starts) for one in missing}
        lock = threading.Lock()

        def fit(one: tuple[tuple[str, ...], TreeParams], i: int) -> None:
            found = fit_fold(replace(self.problem, params=one[1]), one[0], starts[i], self.gap)
            with lock:
                waiting[one][i] = found
                whole = all(f is not None for f in waiting[one])
            if whole:
                result = pooled_score(waiting[one])
                self.ledger.put(missing[one], [result.score, result.score_std, result.rounds])

        together = fits_at_once(self.problem, max((len(names) for names, _ in missing), default=0))
        run_together([lambda n=n, i=i: fit(n, i) for n in missing for i in range(len(starts))], together)
        return [CvResult(*self.ledger.get(self._key(*one))) for one in asked]

    def __call__(self, features: Sequence[str]) -> CvResult:
        return self.many([features])[0]
