"""Where each series starts and ends in the panel sorted by series and time."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelwright.operators.ordering import running_totals
from panelwright.spec import PanelSpec


def series_offsets(df: DataFrame, spec: PanelSpec, train_time: int, test_time: int) -> DataFrame:
    """One row per series: its number and the row offsets of start, end of training, end of test and end."""
    t = F.col(spec.time)
    sizes = df.groupBy(*spec.keys).agg(
        F.count_if(t <= train_time).alias("_train"),
        F.count_if(t <= test_time).alias("_known"),
        F.count(F.lit(1)).alias("_all"),
    )
    placed = running_totals(sizes, spec.keys, {"_end": "_all", "_number": "1L"})
    start = F.col("_end") - F.col("_all")
    return placed.select(
        *spec.keys,
        (F.col("_number") - 1).alias("series_no"),
        start.alias("start_row"),
        (start + F.col("_train")).alias("train_end_row"),
        (start + F.col("_known")).alias("test_end_row"),
        F.col("_end").alias("end_row"),
    )


def series_phase(df: DataFrame, spec: PanelSpec, train_time: int, test_time: int) -> DataFrame:
    """Tag every row with its phase: train, test or future."""
    t = F.col(spec.time)
    phase = F.when(t <= train_time, "train").when(t <= test_time, "test").otherwise("future")
    return df.withColumn("phase", phase)
