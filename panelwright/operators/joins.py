"""Joins of a panel with dimensions, templates, forecasts and truth.

No side is forced to be broadcast here: Spark broadcasts a dimension whose size is below its threshold and otherwise
shuffles both sides, splitting hot keys at run time.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def enrich(fact: DataFrame, dimensions: dict[str, DataFrame], last: str | None = None) -> DataFrame:
    """Inner join of the fact table with each dimension; ``dimensions`` maps join key to table.

    ``last`` names a column to move to the end.
    """
    for key, dimension in dimensions.items():
        fact = fact.join(dimension, key)
    if last is None:
        return fact
    return fact.select(*[c for c in fact.columns if c != last], last)


def scored_rows(rows: DataFrame, forecasts: DataFrame, id_col: str) -> DataFrame:
    """Rows that have a forecast."""
    return rows.join(forecasts.select(id_col).distinct(), id_col, "left_semi")


def align(truth: DataFrame, forecasts: DataFrame, id_col: str, target: str, out: str = "forecast") -> DataFrame:
    """Pair each forecast with the target of the same id."""
    named = forecasts.withColumnRenamed(target, out) if target in forecasts.columns else forecasts
    return truth.select(id_col, F.col(target).alias("actual")).join(named, id_col)


def backfill_truth(rows: DataFrame, truth: DataFrame, id_col: str, target: str) -> DataFrame:
    """Set the target of every row whose id the truth table knows; other rows keep theirs."""
    known = truth.select(id_col, F.col(target).alias("_truth"))
    joined = rows.join(known, id_col, "left")
    return joined.select(*[F.coalesce("_truth", c).alias(c) if c == target else F.col(c) for c in rows.columns])


def in_template_order(template: DataFrame, forecasts: DataFrame, id_col: str, order: Sequence[str]) -> DataFrame:
    """Forecasts for exactly the ids of the template, sorted the way the template is; missing ones stay NULL."""
    columns = [c for c in forecasts.columns if c != id_col]
    keep = list(dict.fromkeys([id_col, *order]))
    return template.select(*keep).join(forecasts, id_col, "left").orderBy(*order).select(*keep, *columns)
