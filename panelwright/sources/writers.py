"""Writers of split files, forecasts and submissions."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelwright.functions.columns import half_even, suffixed
from panelwright.operators.contracts import check_missing, check_same_ids, require
from panelwright.operators.joins import in_template_order
from panelwright.operators.splits import Holdout


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").csv(path, header=True)


def write_holdout(split: Holdout, history: str, future: str, template: str, suffix: str = "_virtual") -> dict[str, str]:
    """Write the three parts of a back-test split as CSV next to the given names, and return the new names."""
    tables = {history: split.history, future: split.future, template: split.truth}
    paths = {name: suffixed(name, suffix) for name in tables}
    for name, table in tables.items():
        write_csv(table, paths[name])
    return paths


def submission(template: DataFrame, forecasts: DataFrame, id_col: str, target: str, order: Sequence[str]) -> DataFrame:
    """Forecasts rounded to whole numbers, for the ids of the template and in its order."""
    rows = in_template_order(template.select(*dict.fromkeys([id_col, *order])), forecasts.select(id_col, target), id_col, order)
    return rows.withColumn(target, half_even(target))


def write_submission(
    template: DataFrame, forecasts: DataFrame, id_col: str, target: str, order: Sequence[str], path: str
) -> None:
    """Check that the forecasts cover the template exactly, then write them as CSV."""
    require(check_same_ids(template, forecasts, id_col), "same_ids")
    require(check_missing(forecasts, target), "complete")
    write_csv(submission(template, forecasts, id_col, target, order).select(id_col, target), path)


def write_forecasts(forecasts: DataFrame, path: str) -> None:
    """Store forecasts by stage and alpha, so that one set can be read alone."""
    forecasts.write.mode("overwrite").partitionBy("stage", "alpha").parquet(path)


def read_forecasts(spark: SparkSession, path: str, stage: str | None = None, alpha: str | None = None) -> DataFrame:
    stored = spark.read.parquet(path).withColumn("alpha", F.col("alpha").cast("string"))
    if stage is not None:
        stored = stored.where(F.col("stage") == stage)
    return stored if alpha is None else stored.where(F.col("alpha") == alpha)


def write_settings(spark: SparkSession, settings: dict, path: str) -> None:
    """Store chosen features or lag settings as one JSON text."""
    spark.createDataFrame([(json.dumps(settings),)], "value string").coalesce(1).write.mode("overwrite").text(path)


def read_settings(spark: SparkSession, path: str) -> dict:
    return json.loads(spark.read.text(path, wholetext=True).first()["value"])
