"""Column expressions shared by the operators. All of them stay inside generated code."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values of the lattice the published order counts lie on: first value, period, offsets inside a period.
LATTICE_START = 13
LATTICE_PERIOD = 27
LATTICE_OFFSETS = (0, 1, 2, 13, 14, 15)


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def nan_to_null(df: DataFrame) -> DataFrame:
    """Replace NaN by NULL in every floating column, so that averages skip missing values."""
    floating = [f.name for f in df.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in floating}) if floating else df


def log_target(c: str | Column) -> Column:
    """Forget scale differences: ln(y + 1)."""
    return F.log1p(_col(c).cast("double"))


def invert_log_target(c: str | Column) -> Column:
    """Undo :func:`log_target` after lifting negative log values to zero."""
    x = _col(c)
    return F.expm1(F.when(x < 0, F.lit(0.0)).otherwise(x))


def half_even(c: str | Column) -> Column:
    """Round to a whole number, halves to the even neighbour."""
    return F.rint(_col(c)).cast("bigint")


def ratio(numerator: str | Column, denominator: str | Column) -> Column:
    """Quotient that is NULL for a zero denominator."""
    return F.try_divide(_col(numerator).cast("double"), _col(denominator).cast("double"))


def is_whole(c: str | Column) -> Column:
    """Whether a value is a whole number up to rounding noise (absolute 1e-8, relative 1e-5)."""
    x = _col(c).cast("double")
    return F.abs(x - F.rint(x)) <= F.lit(1e-8) + F.lit(1e-5) * F.abs(F.rint(x))


def on_lattice(c: str | Column) -> Column:
    """Whether a count lies on the lattice of published order counts."""
    x = _col(c)
    return (x >= LATTICE_START) & ((x - LATTICE_START) % LATTICE_PERIOD).isin(*LATTICE_OFFSETS)


def lattice_value(index: str | Column) -> Column:
    """The lattice value at a zero-based position."""
    i, size = _col(index), len(LATTICE_OFFSETS)
    offsets = F.array(*[F.lit(o) for o in LATTICE_OFFSETS])
    inside = F.element_at(offsets, (i % size + 1).cast("int"))
    return (F.lit(LATTICE_START) + F.floor(i / size) * LATTICE_PERIOD + inside).cast("bigint")


def lattice_index(value: str | Column) -> Column:
    """Position of a lattice value, from its period and its offset inside the period."""
    shifted = _col(value) - LATTICE_START
    offset = shifted % LATTICE_PERIOD
    place = F.coalesce(*[F.when(offset == o, F.lit(n)) for n, o in enumerate(LATTICE_OFFSETS)])
    return (F.floor(shifted / LATTICE_PERIOD) * len(LATTICE_OFFSETS) + place).cast("bigint")


def series_label(keys: Sequence[str], averaged: Column) -> Column:
    """Text label ``Averaged key:value  key:value``; the first word only where rows share a period."""
    parts = [F.concat(F.lit(f"{k}:"), F.col(k).cast("string"), F.lit("  ")) for k in keys]
    return F.concat(F.when(averaged, F.lit("Averaged ")).otherwise(F.lit("")), *parts)


def suffixed(path: str, suffix: str) -> str:
    """Insert a suffix before the extension of a dataset name."""
    stem, dot, extension = path.rpartition(".")
    return f"{stem}{suffix}.{extension}" if dot else path + suffix
