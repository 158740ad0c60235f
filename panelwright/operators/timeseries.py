"""Series averaged over time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelwright.functions.columns import series_label


def ts_average(df: DataFrame, time: str, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Mean of the columns in every period, for each category combination of ``by``."""
    return df.groupBy(*by, time).agg(*[F.avg(c).alias(c) for c in columns])


def ts_average_flag(df: DataFrame, time: str, by: Sequence[str]) -> DataFrame:
    """Per category combination: rows, distinct periods, whether rows share a period, and a label."""
    periods = df.groupBy(*by, time).agg(F.count(F.lit(1)).alias("_rows"))
    sizes = periods.groupBy(*by).agg(F.sum("_rows").alias("rows"), F.count(F.lit(1)).alias("periods"))
    averaged = F.col("periods") < F.col("rows")
    return sizes.withColumn("averaged", averaged).withColumn("label", series_label(by, averaged))
