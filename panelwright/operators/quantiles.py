"""Exact quantiles by group, for groups of any size.

The built-in ``percentile`` and ``median`` keep every distinct value of a group in one buffer. Here equal values are
counted before the shuffle, the distinct values are numbered over a global order, and each quantile is read off at its
position, so that a group with most of the rows is spread over all tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelwright.operators.ordering import running_totals
from panelwright.storage import BroadcastBudget, materialize, stored_bytes


def value_positions(df: DataFrame, groups: Sequence[str], value: str) -> DataFrame:
    """Distinct values by group with ``n`` rows each and ``upto``, the rows of the group up to this value.

    Rows without a value or without a group key are left out.
    """
    present = df.select(*groups, value).dropna(subset=[*groups, value])
    counts = present.groupBy(*groups, value).agg(F.count(F.lit(1)).alias("n"))
    # Stored, so that the running totals are taken once for the starts and the rows.
    ordered = materialize(running_totals(counts, [*groups, value], {"_upto": "n"}), "positions")
    starts = ordered.groupBy(*groups).agg(
        F.min(F.col("_upto") - F.col("n")).alias("_start"), F.sum("n").alias("group_rows")
    )
    starts = materialize(starts, "group-starts")  # one row per group
    joined = ordered.join(BroadcastBudget().sized(starts, stored_bytes(starts)), [*groups])
    return joined.select(*groups, value, "n", (F.col("_upto") - F.col("_start")).alias("upto"), "group_rows")


def quantiles(df: DataFrame, groups: Sequence[str], value: str, probabilities: dict[str, float]) -> DataFrame:
    """Linearly interpolated quantiles of ``value`` by group; ``probabilities`` maps output column to probability."""
    by = list(groups) or ["_all"]
    positions = value_positions(df if groups else df.withColumn("_all", F.lit(1)), by, value)
    x, upto, before = F.col(value).cast("double"), F.col("upto"), F.col("upto") - F.col("n")
    picks, outputs = [], []
    for i, (out, p) in enumerate(probabilities.items()):
        place = F.lit(float(p)) * (F.col("group_rows") - 1)
        low, high = F.floor(place), F.ceil(place)
        picks += [
            F.max(F.when((before <= low) & (low < upto), x)).alias(f"_low{i}"),
            F.max(F.when((before <= high) & (high < upto), x)).alias(f"_high{i}"),
            F.max(place - low).alias(f"_part{i}"),
        ]
        outputs.append((F.col(f"_low{i}") + (F.col(f"_high{i}") - F.col(f"_low{i}")) * F.col(f"_part{i}")).alias(out))
    return positions.groupBy(*by).agg(*picks).select(*groups, *outputs)
