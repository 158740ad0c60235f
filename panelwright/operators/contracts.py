"""Checks on input and output tables. Each returns one row of counts; nothing is collected from the data itself."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def check_same_ids(left: DataFrame, right: DataFrame, id_col: str) -> DataFrame:
    """Compare two id columns as multisets: ids with more copies on the left, on the right, and a verdict."""
    signed = left.select(id_col, F.lit(1).alias("_side")).unionAll(right.select(id_col, F.lit(-1).alias("_side")))
    balance = signed.groupBy(id_col).agg(F.sum("_side").alias("_balance"))
    return balance.agg(
        F.count_if(F.col("_balance") > 0).alias("only_left"),
        F.count_if(F.col("_balance") < 0).alias("only_right"),
        F.coalesce(F.bool_and(F.col("_balance") == 0), F.lit(True)).alias("same_ids"),
    )


def check_time_order(history: DataFrame, future: DataFrame, time: str) -> DataFrame:
    """Whether every future row comes after all of the history."""
    known = history.select(F.col(time).alias("_known"), F.lit(None).cast("bigint").alias("_asked"))
    asked = future.select(F.lit(None).cast("bigint").alias("_known"), F.col(time).alias("_asked"))
    ends = known.unionByName(asked).agg(F.max("_known").alias("last_known"), F.min("_asked").alias("first_future"))
    return ends.withColumn("in_order", F.col("first_future") > F.col("last_known"))


def check_missing(forecasts: DataFrame, column: str) -> DataFrame:
    """Rows, rows without a forecast (NULL or NaN), and a verdict."""
    missing = F.count_if(F.col(column).isNull() | F.isnan(F.col(column).cast("double")))
    return forecasts.agg(F.count(F.lit(1)).alias("rows"), missing.alias("missing")).withColumn(
        "complete", F.col("missing") == 0
    )


def check_unique_series(df: DataFrame, keys: Sequence[str], time: str) -> DataFrame:
    """Number of (series, period) pairs, how many of them have several rows, and a verdict."""
    pairs = df.groupBy(*keys, time).agg(F.count(F.lit(1)).alias("_rows"))
    return pairs.agg(
        F.count(F.lit(1)).alias("pairs"), F.count_if(F.col("_rows") > 1).alias("repeated")
    ).withColumn("unique", F.col("repeated") == 0)


def require(check: DataFrame, verdict: str) -> None:
    """Raise when a one-row check fails."""
    row = check.first()
    if not row[verdict]:
        raise ValueError(f"contract {verdict} failed: {row.asDict()}")
