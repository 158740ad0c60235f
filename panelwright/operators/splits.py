"""Time bounds, back-test splits and causal folds."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Bounds:
    """Training ends at ``train_time``, the last known period is ``test_time``, ``tstep`` periods are forecast."""

    start: int
    train_time: int
    test_time: int
    end: int

    @property
    def tstep(self) -> int:
        return self.end - self.test_time

    def origin(self, back_test: bool) -> int:
        """Last period a forecast may use: of the training part in a back-test, else of the history."""
        return self.train_time if back_test else self.test_time


def time_bounds(history: DataFrame, future: DataFrame, time: str, keys: Sequence[str]) -> DataFrame:
    """One row: first, last training, last known and last period, forecast length and number of series."""
    known = history.select(*keys, F.col(time).alias("_t"), F.lit(True).alias("_known"))
    asked = future.select(*keys, F.col(time).alias("_t"), F.lit(False).alias("_known"))
    series = known.unionByName(asked).groupBy(*keys).agg(
        F.min(F.when(F.col("_known"), F.col("_t"))).alias("_start"),
        F.max(F.when(F.col("_known"), F.col("_t"))).alias("_last"),
        F.max(F.when(~F.col("_known"), F.col("_t"))).alias("_end"),
    )
    ends = series.agg(
        F.min("_start").alias("start_time"),
        F.max("_last").alias("test_time"),
        F.max("_end").alias("end_time"),
        F.count(F.lit(1)).alias("series"),
    )
    tstep = F.col("end_time") - F.col("test_time")
    return ends.select(
        "start_time", (F.col("test_time") - tstep).alias("train_time"), "test_time", "end_time", tstep.alias("tstep"), "series"
    )


def read_bounds(history: DataFrame, future: DataFrame, time: str) -> Bounds:
    """The same bounds as a driver-side value."""
    known = history.agg(F.min(time).alias("start"), F.max(time).alias("last")).first()
    end = future.agg(F.max(time).alias("end")).first()["end"]
    return Bounds(known["start"], known["last"] - (end - known["last"]), known["last"], end)


@dataclass(frozen=True)
class Holdout:
    history: DataFrame
    future: DataFrame
    truth: DataFrame


def holdout_split(df: DataFrame, time: str, id_col: str, target: str, last: int, periods: int) -> Holdout:
    """Turn the last ``periods`` known periods into rows to forecast, and keep their targets apart."""
    cut = last - periods
    held = df.where((F.col(time) > cut) & (F.col(time) <= last))
    emptied = held.withColumn(target, F.lit(None).cast(df.schema[target].dataType))
    return Holdout(df.where(F.col(time) <= cut), emptied, held.select(id_col, target))


def gap_roles(df: DataFrame, time: str, bounds: Bounds, gap: int, back_test: bool = True, out: str = "role") -> DataFrame:
    """Mark rows ``train`` up to the origin minus a gap, ``test`` after the origin; rows of neither role drop."""
    origin, t = bounds.origin(back_test), F.col(time)
    # A plain condition on the period reaches the file scan; a condition on the role would not.
    wanted = df.where((t <= origin - gap) | ((t > origin) & (t <= bounds.test_time)))
    return wanted.withColumn(out, F.when(t <= origin - gap, "train").otherwise("test"))


def fold_starts(nfold: int, tstep: int, max_t: int) -> list[tuple[int, int]]:
    """(fold number, last period before its test part) of consecutive test parts that end at ``max_t``."""
    return [(k, max_t - (nfold - k) * tstep) for k in range(nfold)]


def causal_folds(df: DataFrame, time: str, nfold: int, tstep: int, max_t: int, gap: int = 0) -> DataFrame:
    """Repeat each row once per fold it takes part in, with ``fold`` and ``role``.

    A fold trains on the past of its test part only, less a gap. Rows carry their folds in an array that is unfolded
    in place, so no join is needed.
    """
    t = F.col(time)
    entries = []
    for k, start in fold_starts(nfold, tstep, max_t):
        role = F.when(t <= start - gap, "train").when((t > start) & (t <= start + tstep), "test")
        entries.append(F.when(role.isNotNull(), F.struct(F.lit(k).cast("bigint").alias("fold"), role.alias("role"))))
    return df.select("*", F.inline(F.filter(F.array(*entries), lambda e: e.isNotNull())))
