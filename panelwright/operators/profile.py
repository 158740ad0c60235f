"""Column profiles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelwright.functions.names import literal, quoted
from panelwright.operators.quantiles import quantiles
from panelwright.storage import materialize


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]


def unpivot(df: DataFrame, columns: Sequence[str], as_type: str, keep: Sequence[str] = ()) -> DataFrame:
    """Long form (keep..., column, value)."""
    cells = ", ".join(f"struct({literal(c)} AS column, cast({quoted(c)} as {as_type}) AS value)" for c in columns)
    return df.selectExpr(*[quoted(k) for k in keep], f"inline(array({cells}))")


def _per_column(df: DataFrame, columns: Sequence[str], facts: dict[str, str]) -> DataFrame:
    """Aggregate all columns in one pass, one row per column; ``facts`` maps output to SQL with ``{c}`` for the column."""
    wide = df.selectExpr(
        *[f"{f.format(c=quoted(c))} AS {name}_{i}" for i, c in enumerate(columns) for name, f in facts.items()]
    )
    rows = [
        f"struct({literal(c)} AS column, {', '.join(f'{name}_{i} AS {name}' for name in facts)})"
        for i, c in enumerate(columns)
    ]
    return wide.selectExpr(f"inline(array({', '.join(rows)}))")


def profile_numeric(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Count, mean, sample standard deviation, minimum, quartiles and maximum of each numeric column."""
    columns = list(columns or numeric_columns(df))
    # The slim columns are stored, so that the source is read once for moments and quartiles.
    clean = materialize(
        df.selectExpr(*[f"nullif(cast({quoted(c)} as double), double('NaN')) AS {quoted(c)}" for c in columns]), "profile"
    )
    moments = _per_column(
        clean,
        columns,
        {"count": "count({c})", "mean": "avg({c})", "std": "stddev_samp({c})", "min": "min({c})", "max": "max({c})"},
    )
    quartiles = quantiles(
        unpivot(clean, columns, "double"), ["column"], "value", {"q25": 0.25, "q50": 0.5, "q75": 0.75}
    )
    # Both sides have one row per profiled column.
    return moments.join(F.broadcast(quartiles), "column", "left").select(
        "column", "count", "mean", "std", "min", "q25", "q50", "q75", "max"
    )


def profile_string(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Count, distinct count, most frequent value and its frequency of each text column; ties go to the first value."""
    columns = list(columns or string_columns(df))
    cells = unpivot(df, columns, "string").where(F.col("value").isNotNull())
    counts = cells.groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    best = F.min_by(F.struct("value", "n"), F.struct(-F.col("n"), F.col("value")))
    return counts.groupBy("column").agg(
        F.sum("n").alias("count"), F.count(F.lit(1)).alias("unique"), best.alias("best")
    ).select("column", "count", "unique", F.col("best.value").alias("top"), F.col("best.n").alias("freq"))


def profile_quality(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Zeros, missing values and distinct values of each column."""
    columns = list(columns or df.columns)
    numeric = set(numeric_columns(df))
    floating = {f.name for f in df.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    # Adding zero turns -0.0 into 0.0, which would differ as text.
    values = {c: f"nullif({quoted(c)} + 0.0D, double('NaN'))" if c in floating else quoted(c) for c in columns}
    clean = materialize(df.selectExpr(*[f"{v} AS {quoted(c)}" for c, v in values.items()]), "quality")
    missing = _per_column(clean, columns, {"missing_count": "count_if({c} IS NULL)"})
    numbers = [c for c in columns if c in numeric]
    simple = missing.withColumn("zero_count", F.lit(0).cast("bigint"))
    if numbers:
        counted = _per_column(clean, numbers, {"missing_count": "count_if({c} IS NULL)", "zero_count": "count_if({c} = 0)"})
        others = [c for c in columns if c not in numeric]
        simple = counted if not others else simple.where(~F.col("column").isin(*numbers)).unionByName(counted)
    cells = unpivot(clean, columns, "string").where(F.col("value").isNotNull()).distinct()
    unique = cells.groupBy("column").agg(F.count(F.lit(1)).alias("unique_count"))
    joined = simple.join(F.broadcast(unique), "column", "left")  # one row per column
    return joined.withColumn("unique_count", F.coalesce("unique_count", F.lit(0)))


def schema_report(df: DataFrame) -> DataFrame:
    """Position, name, non-null count and type of each column."""
    counts = _per_column(df, df.columns, {"non_null": "count({c})"})
    names = ", ".join(literal(f.name) for f in df.schema)
    types = ", ".join(literal(f.dataType.simpleString()) for f in df.schema)
    place = f"array_position(array({names}), column)"
    return counts.selectExpr(
        f"{place} - 1 AS position", "column", "non_null", f"element_at(array({types}), cast({place} as int)) AS type"
    )
