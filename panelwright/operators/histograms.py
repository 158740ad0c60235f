"""Histograms with the mean target of every bin."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelwright.functions.columns import is_whole
from panelwright.storage import materialize


@dataclass(frozen=True)
class Bins:
    """Equal bins of one column."""

    column: str
    low: float
    width: float
    count: int
    categorical: bool

    def index(self, x: Column) -> Column:
        """Bin number; the largest value belongs to the last bin."""
        place = F.floor((x - F.lit(self.low)) / F.lit(self.width))
        # least() passes over NULL, so a missing value is kept out explicitly.
        return F.when(x.isNotNull(), F.least(place, F.lit(self.count - 1))).cast("bigint")


def plan_bins(df: DataFrame, columns: Sequence[str], nbins: int) -> dict[str, Bins]:
    """Choose the bins of every column from one pass that returns a single row.

    Few, non-negative, whole values count as categories: bins half a unit wide, centred on the values. Distinct values
    are counted exactly only where an estimate says they are few.
    """
    facts = df.agg(
        *[F.min(c).alias(f"{c}|min") for c in columns],
        *[F.max(c).alias(f"{c}|max") for c in columns],
        *[F.coalesce(F.bool_and(is_whole(c)), F.lit(False)).alias(f"{c}|whole") for c in columns],
        *[F.approx_count_distinct(c).alias(f"{c}|about") for c in columns],
    ).first()
    maybe = [
        c
        for c in columns
        if facts[f"{c}|min"] is not None
        and facts[f"{c}|min"] >= 0
        and facts[f"{c}|whole"]
        and facts[f"{c}|about"] < 2 * nbins + 10
    ]
    exact = df.agg(*[F.count_distinct(c).alias(c) for c in maybe]).first().asDict() if maybe else {}
    plans = {}
    for c in columns:
        low, high = facts[f"{c}|min"], facts[f"{c}|max"]
        if low is None:
            continue
        if c in exact and exact[c] < nbins:
            plans[c] = Bins(c, low - 0.25, 0.5, int(math.floor((high - low) / 0.5 + 0.5)) + 1, True)
        elif low == high:
            plans[c] = Bins(c, low - 0.5, 1.0 / nbins, nbins, False)
        else:
            plans[c] = Bins(c, low, (high - low) / nbins, nbins, False)
    return plans


def histograms(df: DataFrame, columns: Sequence[str], target: str, nbins: int, no_data: float = math.nan) -> DataFrame:
    """One row per column and bin, empty bins included: edges, rows and mean target.

    Rows whose value is missing or equals ``no_data`` are left out of that column's histogram.
    """
    cells = {}
    for c in columns:
        x = F.col(c).cast("double")
        present = ~F.isnan(x)
        cells[c] = F.when(present if math.isnan(no_data) else present & (x != no_data), x)
    y = F.col(target).cast("double")
    # Stored, so that the source is read once for the plan, the exact counts and the bins.
    values = materialize(df.select(F.when(~F.isnan(y), y).alias("_target"), *[x.alias(c) for c, x in cells.items()]), "histogram")
    plans = plan_bins(values, list(columns), nbins)
    if not plans:
        raise ValueError("no column has a value")
    tagged = F.array(
        *[F.struct(F.lit(c).alias("column"), p.index(F.col(c)).alias("bin")) for c, p in plans.items()]
    )
    filled = (
        values.select("_target", F.inline(tagged))
        .where(F.col("bin").isNotNull())
        .groupBy("column", "bin")
        .agg(F.count(F.lit(1)).alias("rows"), F.avg("_target").alias("mean_target"))
    )
    plan_rows = {
        "column": list(plans),
        "categorical": [p.categorical for p in plans.values()],
        "low": [p.low for p in plans.values()],
        "width": [p.width for p in plans.values()],
        "bins": [p.count for p in plans.values()],
    }
    spark = df.sparkSession
    frame = F.broadcast(spark.createDataFrame(pa.table(plan_rows)))  # one row per column
    # Bins are numbered by a distributed range, as a column of far-apart categories may have any number of them.
    numbers = [spark.range(p.count).select(F.lit(c).alias("column"), F.col("id").alias("bin")) for c, p in plans.items()]
    every = reduce(DataFrame.unionByName, numbers).join(frame, "column")
    return every.join(filled, ["column", "bin"], "left").select(
        "column",
        "categorical",
        "bin",
        (F.col("low") + F.col("width") * F.col("bin")).alias("bin_low"),
        (F.col("low") + F.col("width") * (F.col("bin") + 1)).alias("bin_high"),
        F.coalesce("rows", F.lit(0)).alias("rows"),
        "mean_target",
    )
