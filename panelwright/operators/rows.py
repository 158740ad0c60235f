"""Projections, filters and row edits."""

from __future__ import annotations

import math
from collections.abc import Sequence
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelwright.functions.columns import log_target


def prune_columns(df: DataFrame, roles: Sequence[str], features: Sequence[str]) -> DataFrame:
    """Keep the role columns and the chosen features, in the order of the table."""
    keep = {*roles, *features}
    return df.select(*[c for c in df.columns if c in keep])


def time_slice(df: DataFrame, time: str, after: int | None = None, upto: int | None = None) -> DataFrame:
    """Rows with ``after`` < time <= ``upto``; an open end is None."""
    if after is not None:
        df = df.where(F.col(time) > after)
    if upto is not None:
        df = df.where(F.col(time) <= upto)
    return df


def filter_equals(df: DataFrame, values: dict[str, Any]) -> DataFrame:
    """Rows where every named column equals its value."""
    for column, value in values.items():
        df = df.where(F.col(column) == value)
    return df


def valid_rows(df: DataFrame, columns: Sequence[str], no_data: float = math.nan) -> DataFrame:
    """Drop a row if any of the columns holds the no-data value; NaN as no-data also stands for NULL."""
    for column in columns:
        missing = math.isnan(no_data)
        keep = ~F.isnan(F.col(column).cast("double")) if missing else F.col(column) != F.lit(no_data)
        df = df.where(F.col(column).isNotNull() & keep) if missing else df.where(F.coalesce(keep, F.lit(True)))
    return df


def log_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Natural logarithm of the columns; NULL where a value is not positive."""
    return df.withColumns({c: F.ln(F.col(c).cast("double")) for c in columns})


def with_log_target(df: DataFrame, target: str, out: str | None = None) -> DataFrame:
    """Replace the target by ln(y + 1), or add it as ``out``."""
    return df.withColumn(out or target, log_target(target))


def head_rows(df: DataFrame, order: Sequence[str], n: int = 10) -> DataFrame:
    """The first ``n`` rows in a stated order."""
    return df.orderBy(*order).limit(n)


def union_future(history: DataFrame, future: DataFrame) -> DataFrame:
    """History followed by the rows to forecast; columns the future lacks become NULL."""
    return history.unionByName(future, allowMissingColumns=True)


def empty_result(template: DataFrame, target: str) -> DataFrame:
    """The template with its target emptied, to be filled by forecasts."""
    return template.withColumn(target, F.lit(None).cast("double"))
