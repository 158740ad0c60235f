"""Regressors on Spark ML."""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field, replace
from typing import Any

from pyspark.errors import NumberFormatException
from pyspark.ml.feature import StandardScaler, VectorAssembler, VectorSlicer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.pipeline import Pipeline
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor, GeneralizedLinearRegression
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelwright.functions.names import quoted
from panelwright.operators.scoring import ACTUAL, r2, r2_weighted
from panelwright.plans.boosting import Blocks, Fit, Periods, fit_shared, spark_model
from panelwright.sources.writers import read_settings, write_settings
from panelwright.storage import materialize, new_path, shared_folder

# Stands for a missing feature value, below any value a feature may take, so that one split isolates it.
MISSING = -1e300
#: Column of how many equal rows a stored row stands for.
COUNT = "_rows"
#: A fit reads all values of up to so many rows for its splits; Spark draws a sample of more.
WHOLE_ROWS = 10_000
#: Bytes of a stored vector's rows that one task of a fit reads.
TASK_BYTES = 64 << 20


@dataclass(frozen=True)
class TreeParams:
    """Settings of boosted trees. ``tolerance`` is the least relative gain that keeps boosting on validation rows."""

    rounds: int = 100
    learning_rate: float = 0.05
    min_rows: int = 40
    depth: int = 5
    max_bins: int = 128
    tolerance: float = 0.001
    seed: int = 1


@dataclass
class Fitted:
    """A fitted tree ensemble with the features it needs."""

    model: GBTRegressionModel
    features: list[str]
    scores: dict[str, float | None] = field(default_factory=dict)

    @property
    def rounds(self) -> int:
        return self.model.getNumTrees

    def predict(self, rows: DataFrame, out: str = "forecast", region: str | None = None, matrix: Matrix | None = None) -> DataFrame:
        """Add the prediction as column ``out`` and, if named, the leaf of the first tree as column ``region``.

        The first tree alone follows the target itself, so its leaves are the coarsest groups of similar rows.
        """
        assembled = assemble(rows, self.features, matrix=matrix)
        model = self.model if region is None else self.model.copy().setLeafCol("_leaves")
        found = model.transform(assembled).withColumnRenamed("_prediction", out).drop("_features")
        if region is None:
            return found
        return found.withColumn(region, vector_to_array("_leaves")[0].cast("int")).drop("_leaves")

    def importances(self) -> dict[str, float]:
        """Share of every feature in the gain of all splits."""
        return dict(zip(self.features, (float(v) for v in self.model.featureImportances.toArray()), strict=True))

    def split_counts(self, spark: SparkSession) -> dict[str, int]:
        """How many inner nodes split by every feature, from the node table of the saved model."""
        return {f: n for f, n in zip(self.features, _counts(self.nodes(spark), len(self.features)), strict=True)}

    def nodes(self, spark: SparkSession) -> DataFrame:
        """One row per node of every tree: tree, node, feature (-1 for a leaf), gain, rows, left, right."""
        path = new_path(spark, "nodes")
        self.model.write().save(path)
        node = F.col("nodeData")
        return spark.read.parquet(f"{path}/data").select(
            F.col("treeID").alias("tree"), node["id"].alias("node"), node["split"]["featureIndex"].alias("feature"),
            node["gain"].alias("gain"), node["impurityStats"][0].cast("bigint").alias("rows"),
            node["leftChild"].alias("left"), node["rightChild"].alias("right"),
        )

    def save(self, spark: SparkSession, path: str) -> None:
        self.model.write().overwrite().save(f"{path}/model")
        settings = {"features": self.features, "scores": self.scores}
        write_settings(spark, settings, f"{path}/settings")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> Fitted:
        return cls(GBTRegressionModel.load(f"{path}/model"), **read_settings(spark, f"{path}/settings"))


class Grown(Fitted):
    """A fit on coded rows; it knows the moments of its targets and errors, and becomes Spark's model when one is needed."""

    def __init__(self, spark: SparkSession, fit: Fit, features: list[str]):
        self.features, self.scores, self.fit = features, {}, fit
        self._spark, self._model = spark, None

    @property
    def model(self) -> GBTRegressionModel:
        if self._model is None:
            self._model = spark_model(self._spark, self.fit, len(self.features))
        return self._model

    @property
    def rounds(self) -> int:
        return self.fit.best


def _counts(nodes: DataFrame, features: int) -> list[int]:
    found = {r["feature"]: r["n"] for r in nodes.where("left >= 0").groupBy("feature").agg(F.count(F.lit(1)).alias("n")).collect()}
    return [found.get(i, 0) for i in range(features)]


@dataclass(frozen=True)
class Matrix:
    """Names of the columns of a stored vector, so that fits cut theirs out by position.

    ``parts`` is how many tasks a pass over all rows is worth: a fit launches some twenty small jobs, and many tasks
    with few rows each would cost more than they compute. ``size`` is the bytes of all ``rows`` in memory. ``coded`` holds the
    rows as blocks of codes while many fits read them (``validation.remembered``).
    """

    places: dict[str, int]
    column: str = "_all"
    parts: int | None = None
    size: int | None = None
    rows: int | None = None
    coded: list[Blocks] = field(default_factory=list, compare=False, repr=False)

    def blocks(self, target: str) -> Blocks | None:
        return self.coded[0] if self.coded and self.coded[0].target == target else None

    def indices(self, features: Sequence[str]) -> list[int]:
        return [self.places[f] for f in features]


def stored_matrix(rows: DataFrame, features: Sequence[str], keep: Sequence[str], partition_by: str | None = None) -> tuple[DataFrame, Matrix]:
    """Assemble all ``features`` once and store the vector next to the columns ``keep``.

    Fits on any of the features read it instead of assembling wide rows anew; with ``partition_by`` they open only the
    files of the periods that they need.
    """
    names = list(dict.fromkeys(features))
    matrix = Matrix({name: i for i, name in enumerate(names)})
    keep = list(dict.fromkeys(keep))
    vector = F.col(matrix.column).alias(matrix.column, metadata={})  # without the names of the parts, which fits would carry along
    wide = assemble(rows, names, matrix.column).select(*[F.col(quoted(c)) for c in keep], vector)
    stored = materialize(wide, "matrix", partition_by)
    count = stored.count()
    size = count * (len(names) + len(keep)) * 8
    return stored, replace(matrix, parts=max(1, math.ceil(size / TASK_BYTES)), size=size, rows=count)


def count_equal(rows: DataFrame, features: Sequence[str], time: str, target: str) -> DataFrame | None:
    """Rows with a target, those with the same period, features and target stored once with their number as ``COUNT``.

    None where features and target have too many different values together for fits to read all of them.
    """
    values = [F.col(quoted(c)) for c in dict.fromkeys([target, *features])]
    known = rows.where(F.col(quoted(target)).isNotNull())
    stored = materialize(known.groupBy(F.col(quoted(time)), *values).agg(F.count(F.lit(1)).alias(COUNT)), "counts")
    # A fit may see every value twice: in its training and in its validation rows.
    few = 2 * stored.select(*values).distinct().count() <= WHOLE_ROWS
    return stored if few else None


def model_path(root: str, stage: str, horizon: int | None, alpha: str) -> str:
    """Where the model of a stage, horizon and quantile is stored."""
    return f"{root}/stage={stage}/horizon={'all' if horizon is None else horizon}/alpha={alpha}"


def unraced(step: Callable[[], Any], tries: int = 5) -> Any:
    """Run a step that launches Spark jobs, again where Spark loses the number of its own execution.

    Spark 4.1 reads the number of the root execution back from the thread's properties and now and then finds none there
    (``SQLExecution.withNewExecutionId``, "Cannot parse null string") when many executions start at once. The step has done
    nothing by then.
    """
    for _ in range(tries - 1):
        try:
            return step()
        except NumberFormatException as error:
            if "Cannot parse null string" not in str(error):
                raise
    return step()


def assemble(rows: DataFrame, features: Sequence[str], out: str = "_features", matrix: Matrix | None = None) -> DataFrame:
    """Put the features into one vector column, or cut them out of the vector that ``matrix`` describes.

    Categories come as codes and are split by the order of the codes, whatever their number; see ``training_frame``.
    """
    if matrix is not None:
        return VectorSlicer(inputCol=matrix.column, outputCol=out, indices=matrix.indices(features)).transform(rows)
    inputs = {f: f"_in_{i}" for i, f in enumerate(features)}
    filled = [f"coalesce(cast({quoted(f)} as double), double('{MISSING!r}')) AS {n}" for f, n in inputs.items()]
    wide = rows.selectExpr("*", *filled)
    return VectorAssembler(inputCols=list(inputs.values()), outputCol=out).transform(wide).drop(*inputs.values())


def fit_trees(
    train: DataFrame,
    features: Sequence[str],
    target: str,
    params: TreeParams,
    held: str | None = None,
    rounds: int | None = None,
    matrix: Matrix | None = None,
    weight: str | None = None,
    periods: Periods | None = None,
) -> Fitted:
    """Fit boosted trees with squared loss.

    ``periods`` says which rows of the matrix are in ``train`` and which of them ``held`` marks. Where the matrix has
    blocks of codes, the fit reads these, together with the fits of other threads.

    ``held`` names a column that is true for validation rows; boosting stops when these no longer gain. ``weight`` names a
    column of how many equal rows each row stands for (``count_equal``); the fit is the one on all of them.
    """
    shared_folder(train.sparkSession)  # boosting writes checkpoints to cut its lineage
    features = list(features)
    blocks = None if matrix is None or periods is None or weight else matrix.blocks(target)
    if blocks is not None:
        asked = Fit(matrix.indices(features), periods, rounds or params.rounds, params.learning_rate, params.min_rows, params.depth,
                    params.max_bins, params.tolerance)
        fit_shared(blocks, asked)
        return Grown(train.sparkSession, asked, features)
    learner = GBTRegressor(
        featuresCol="_features", labelCol=target, predictionCol="_prediction",
        maxIter=rounds or params.rounds, stepSize=params.learning_rate, maxDepth=params.depth, maxBins=params.max_bins,
        minInstancesPerNode=params.min_rows, seed=params.seed, validationTol=params.tolerance,
        maxMemoryInMB=1024, checkpointInterval=10,
    )
    wanted = [F.col(quoted(c)) for c in dict.fromkeys([*(features if matrix is None else [matrix.column]), target])]
    wanted += [F.col(held)] if held else []
    rows = train.where(F.col(quoted(target)).isNotNull()).select(*wanted, *([weight] if weight else []))
    if weight:
        rows = materialize(rows.groupBy(*wanted).agg(F.sum(weight).cast("double").alias(weight)).coalesce(1), "weighted")
        trained = rows.where(~F.col(held)) if held else rows
        least = (params.min_rows - 0.5) / (trained.agg(F.sum(weight)).first()[0] or 1)
        # The least rows of a leaf are a share of all rows here; no split leaves more than half of them on both sides.
        learner = learner.setWeightCol(weight).setMinInstancesPerNode(1 if least < 0.5 else 2**31 - 1)
        learner = learner.setMinWeightFractionPerNode(least if least < 0.5 else 0.0)
    if held:
        learner = learner.setValidationIndicatorCol(held)
    if matrix is not None and matrix.parts is not None:
        rows = rows.coalesce(matrix.parts)
    ready = assemble(rows, features, matrix=matrix)
    return Fitted(unraced(lambda: learner.fit(ready)), features)


def r2_by(
    fitted: Fitted, rows: DataFrame, target: str, part: str, matrix: Matrix | None = None, weight: str | None = None
) -> dict[str, float | None]:
    """R2 of the model for every value of the column ``part``, in one pass over the rows that have a target."""
    scored = fitted.predict(rows.where(F.col(target).isNotNull() & F.col(part).isNotNull()), matrix=matrix)
    if weight is not None:
        return {r[part]: r["r2_weighted"] for r in r2_weighted(scored.withColumn(ACTUAL, F.col(target)), weight, [part]).collect()}
    return {r[part]: r["r2"] for r in scored.groupBy(part).agg(r2(target, "forecast").alias("r2")).collect()}


@dataclass
class FittedCounts:
    """A fitted count model with its inputs and those that missed values in training."""

    model: Any
    features: list[str]
    missing: list[str]

    def predict(self, rows: DataFrame) -> DataFrame:
        """Add the prediction as column ``forecast``."""
        wide, names = _count_inputs(rows, self.features, self.missing)
        return self.model.transform(wide).drop(*names, "_raw", "_features")


def _count_inputs(rows: DataFrame, features: Sequence[str], missing: Sequence[str]) -> tuple[DataFrame, list[str]]:
    inputs = {f"_in_{i}": f"coalesce(cast({quoted(f)} as double), 0D)" for i, f in enumerate(features)}
    inputs |= {f"_no_{i}": f"cast({quoted(f)} IS NULL as double)" for i, f in enumerate(features) if f in missing}
    return rows.selectExpr("*", *[f"{v} AS {n}" for n, v in inputs.items()]), list(inputs)


def fit_poisson(train: DataFrame, features: Sequence[str], target: str) -> FittedCounts:
    """Log-linear count model on inputs scaled to unit deviation.

    A missing input becomes 0, and an input that misses values in training gets a second one that says so.
    """
    known = train.where(F.col(quoted(target)).isNotNull())
    row = known.selectExpr(*[f"bool_or({quoted(f)} IS NULL) AS m{i}" for i, f in enumerate(features)]).first()
    missing = [f for i, f in enumerate(features) if row[f"m{i}"]]
    wide, names = _count_inputs(known, features, missing)
    stages = [
        VectorAssembler(inputCols=names, outputCol="_raw"),
        StandardScaler(inputCol="_raw", outputCol="_features"),
        GeneralizedLinearRegression(family="poisson", link="log", featuresCol="_features", labelCol=target,
                                    predictionCol="forecast", maxIter=25, regParam=1e-6),
    ]
    return FittedCounts(Pipeline(stages=stages).fit(wide), list(features), missing)
