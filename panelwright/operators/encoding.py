"""Category dictionaries and integer codes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelwright.functions.names import literal, quoted
from panelwright.operators.ordering import row_ranks
from panelwright.storage import BROADCAST_BYTES, BroadcastBudget, materialize, stored_bytes


def _entry(df: DataFrame, column: str) -> str:
    """One dictionary entry as SQL. -0.0 becomes 0.0 and NaN counts as missing."""
    kind, name = df.schema[column].dataType, quoted(column)
    clean = f"nullif({name} + 0.0D, double('NaN'))" if isinstance(kind, (T.DoubleType, T.FloatType)) else name
    number = f"cast({clean} as double)" if isinstance(kind, T.NumericType) else "cast(NULL as double)"
    return f"struct({literal(column)} AS column, {number} AS number, cast({clean} as string) AS value)"


def category_dictionary(df: DataFrame, columns: Sequence[str], score: str | None = None) -> DataFrame:
    """Distinct values of each column with codes 0, 1, ... in sorted order: (column, value, number, code).

    Numbers sort as numbers, everything else as text; ``number`` is NULL for text. Missing values get no code. With
    ``score``, an SQL expression over the rows, values are sorted by its mean first, those without one at the start;
    trees can then split a category of any size by the order of its codes.
    """
    entries = ", ".join(_entry(df, c) for c in columns)
    scored = score if score is not None else "cast(NULL as double)"
    cells = df.selectExpr(f"cast({scored} as double) AS _score", f"inline(array({entries}))").where(F.col("value").isNotNull())
    distinct = cells.groupBy("column", "number", "value").agg(F.round(F.avg("_score"), 9).alias("_mean"))
    ranked = materialize(row_ranks(distinct, ["column", "_mean", "number", "value"], "_rank"), "category-ranks")
    first = ranked.groupBy("column").agg(F.min("_rank").alias("_first"))  # one row per encoded column
    coded = ranked.join(F.broadcast(first), "column")
    return coded.select("column", "value", "number", (F.col("_rank") - F.col("_first")).alias("code"))


def encode_categories(
    df: DataFrame, columns: Sequence[str], dictionary: DataFrame | None = None, limit: int = BROADCAST_BYTES
) -> DataFrame:
    """Replace each column by its code; a missing value becomes -1.

    A given ``dictionary`` is taken as stored. Without one the rows are stored, so that the source is read once.
    """
    if dictionary is None:
        df = materialize(df, "category-rows")
        dictionary = category_dictionary(df, columns)
    dictionary = materialize(dictionary, "codes")
    size = stored_bytes(dictionary)  # bounds the part of any column
    result, budget = df, BroadcastBudget(limit)
    for c in columns:
        codes = dictionary.where(F.col("column") == c).select(F.col("value").cast(df.schema[c].dataType).alias("_value"), F.col("code").alias("_code"))
        result = result.join(budget.sized(codes, size), F.col(quoted(c)) == F.col("_value"), "left")
        result = result.withColumn(c, F.coalesce("_code", F.lit(-1).cast("bigint"))).drop("_code", "_value")
    return result.select(*[quoted(c) for c in df.columns])


def category_sizes(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct category combinations, sorted, with their row counts."""
    present = df.dropna(subset=list(columns))
    return present.groupBy(*columns).agg(F.count(F.lit(1)).alias("rows")).orderBy(*columns)


def category_page(df: DataFrame, columns: Sequence[str], start: int, end: int, per_page: int) -> DataFrame:
    """Sorted category combinations number ``start`` to ``end`` (left out), with page number and total count.

    Combinations are ranked over a global order and the range is filtered, so a page at the end costs what the first does.
    """
    present = df.dropna(subset=list(columns))
    sizes = present.groupBy(*columns).agg(F.count(F.lit(1)).alias("rows"))
    ranked = materialize(row_ranks(sizes, list(columns), "_rank"), "category-ranks")
    total = ranked.count()
    position = F.col("_rank") - 1
    return ranked.where((position >= start) & (position < end)).select(
        *columns,
        "rows",
        position.cast("bigint").alias("position"),
        F.floor((position - start) / per_page).alias("page"),
        F.lit(total).cast("bigint").alias("total"),
    )


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """Distinct values of one column."""
    return df.select(column).distinct()
