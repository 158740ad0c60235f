"""Ranks and running totals over a global order, without sending all rows through one task.

A window without a partition key puts the whole table into a single task. Here the rows are range sorted and stored
with their position, and every sorted part starts from the totals of the parts before it. The table of part totals
has at most one row per sort partition, whatever the size of the data.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelwright.functions.names import quoted
from panelwright.storage import materialize

_POSITION, _PART = "_position", "_part"
# monotonically_increasing_id holds the partition in its upper bits and counts rows in the lower 33.
_ROW_BITS = 33


class OrderedRows:
    """Rows stored in a global order, with named values to add up along it.

    ``order`` must tell any two rows apart for ranks and totals to be repeatable.
    """

    def __init__(self, df: DataFrame, order: Sequence[str], values: dict[str, str | Column] | None = None):
        self.columns = [quoted(c) for c in df.columns]
        self.values = {out: F.expr(v) if isinstance(v, str) else v for out, v in (values or {}).items()}
        # The position is taken after the sort and stored, so that no later evaluation can number rows differently.
        self.stored = materialize(
            df.withColumns({f"_v_{out}": v for out, v in self.values.items()})
            .orderBy(*order)
            .withColumn(_POSITION, F.monotonically_increasing_id())
            .withColumn(_PART, F.shiftright(_POSITION, _ROW_BITS)),
            "ordered",
        )

    def count(self) -> int:
        return self.stored.count()

    def totals(self) -> dict[str, int | float | None]:
        """Sum of every value over all rows."""
        return self.stored.agg(*[F.sum(f"_v_{out}").alias(out) for out in self.values]).first().asDict()

    def _starts(self, sums: dict[str, Column]) -> DataFrame:
        """Totals of the parts before each part."""
        earlier = Window.orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
        parts = self.stored.groupBy(_PART).agg(*[v.alias(out) for out, v in sums.items()])
        return parts.select(_PART, *[F.coalesce(F.sum(out).over(earlier), F.lit(0)).alias(out) for out in sums])

    def ranked(self, out: str) -> DataFrame:
        """Number the rows 1, 2, ...; positions inside a part are known already, so nothing is shuffled."""
        starts = self._starts({"_before": F.count(F.lit(1))})
        inside = F.col(_POSITION).bitwiseAND(F.lit((1 << _ROW_BITS) - 1).cast("bigint"))
        placed = self.stored.join(F.broadcast(starts), _PART)
        return placed.select(*self.columns, (F.col("_before") + inside + 1).alias(out))

    def running(self) -> DataFrame:
        """Add the sum of each value over all rows up to and including the current one."""
        starts = self._starts({f"_s_{out}": F.sum(f"_v_{out}") for out in self.values})
        inside = Window.partitionBy(_PART).orderBy(_POSITION).rowsBetween(Window.unboundedPreceding, 0)
        upto = {
            out: F.col(f"_s_{out}") + F.coalesce(F.sum(f"_v_{out}").over(inside), F.lit(0)) for out in self.values
        }
        placed = self.stored.join(F.broadcast(starts), _PART)
        return placed.select(*self.columns, *[total.alias(out) for out, total in upto.items()])


def row_ranks(df: DataFrame, order: Sequence[str], out: str) -> DataFrame:
    """Number all rows 1, 2, ... in a global order."""
    return OrderedRows(df, order).ranked(out)


def running_totals(df: DataFrame, order: Sequence[str], totals: dict[str, str | Column]) -> DataFrame:
    """Add one running total per entry of ``totals``, over a global order."""
    return OrderedRows(df, order, totals).running()
