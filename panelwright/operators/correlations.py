"""Correlation matrices in long form."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelwright.functions.names import literal, quoted
from panelwright.operators.ordering import running_totals
from panelwright.operators.profile import numeric_columns
from panelwright.storage import BroadcastBudget, materialize, stored_bytes

#: (column, value) cells that one task of a rank correlation joins and groups by row, whatever the number of rows.
TASK_CELLS = 2_000_000
#: Bytes in memory up to which the ranks of all distinct values are sent to every executor.
RANK_BYTES = 64 << 20


def _pairs(n: int) -> list[tuple[int, int]]:
    return [(a, b) for a in range(n) for b in range(a, n)]


@dataclass(frozen=True)
class _Set:
    """Pairs that share a presence condition: on its rows every column of the pairs has a value.

    Columns go by their position; ``columns`` maps it to the name of the column of shifted values.
    """

    columns: dict[int, str]
    pairs: list[tuple[int, int]]


def _long(df: DataFrame, sets: Sequence[_Set], names: Sequence[str]) -> DataFrame:
    """Correlations of all pairs of all sets in one pass.

    ``df`` holds the values less a number near their mean, so that plain sums keep their precision. Sums shared by
    many pairs are taken once. A constant column, told by its minimum and maximum, gives NULL, and so does a pair with
    an infinite value on its rows.
    """
    # Written as SQL text: one expression is one call to the driver's JVM, and there are many pairs.
    facts, cells = [], []
    for i, s in enumerate(sets):
        facts.append(f"cast(count({next(iter(s.columns.values()))}) as double) AS n{i}")
        for c, x in s.columns.items():
            facts += [f"sum({x}) AS s{i}_{c}", f"sum({x} * {x}) AS p{i}_{c}_{c}", f"min({x}) < max({x}) AS v{i}_{c}"]
        facts += [f"sum({s.columns[a]} * {s.columns[b]}) AS p{i}_{a}_{b}" for a, b in s.pairs if a != b]
        for a, b in s.pairs:
            both = f"(p{i}_{a}_{b} - s{i}_{a} * s{i}_{b} / n{i})"
            spread = " * ".join(f"(p{i}_{c}_{c} - s{i}_{c} * s{i}_{c} / n{i})" for c in (a, b))
            r = f"nullif(CASE WHEN v{i}_{a} AND v{i}_{b} THEN try_divide({both}, sqrt({spread})) END, double('NaN'))"
            ends = [(literal(names[x]), literal(names[y])) for x, y in dict.fromkeys([(a, b), (b, a)])]
            cells += [f"struct({x} AS a, {y} AS b, {r} AS r)" for x, y in ends]
    return df.selectExpr(*facts).selectExpr(f"inline(array({', '.join(cells)}))")


@dataclass(frozen=True)
class _Presence:
    """Which columns miss values, their means, and the presence condition of every pair."""

    means: list[float]
    conditions: dict[tuple[int, ...], list[tuple[int, int]]]

    @classmethod
    def of(cls, df: DataFrame, n: int) -> _Presence:
        facts = [f"count_if(c{c} IS NULL) AS missing{c}" for c in range(n)]
        # Infinite values have no place in the shift; the pairs that see them give NULL.
        facts += [f"avg(CASE WHEN abs(c{c}) < double('Infinity') THEN c{c} END) AS mean{c}" for c in range(n)]
        row = df.selectExpr(*facts).first()
        conditions: dict[tuple[int, ...], list[tuple[int, int]]] = {}
        for pair in _pairs(n):
            needed = tuple(sorted({c for c in pair if row[f"missing{c}"]}))
            conditions.setdefault(needed, []).append(pair)
        return cls([row[f"mean{c}"] or 0.0 for c in range(n)], conditions)

    def holds(self) -> list[str]:
        return [" AND ".join(f"c{c} IS NOT NULL" for c in needed) or "true" for needed in self.conditions]

    def sets(self) -> list[_Set]:
        found = []
        for i, pairs in enumerate(self.conditions.values()):
            used = dict.fromkeys(c for pair in pairs for c in pair)
            found.append(_Set({c: f"_{i}_{c}" for c in used}, pairs))
        return found


def _numbers(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The columns as numbers, named c0, c1, ..., stored so that the source is read once."""
    named = [f"nullif(cast({quoted(c)} as double), double('NaN')) AS c{i}" for i, c in enumerate(columns)]
    return materialize(df.selectExpr(*named), "columns")


def pearson(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Pearson correlation of all column pairs, each over the rows where both are present."""
    columns = list(columns or numeric_columns(df))
    clean = _numbers(df, columns)
    presence = _Presence.of(clean, len(columns))
    centred = [
        f"CASE WHEN {hold} THEN c{c} - double('{presence.means[c]!r}') END AS {x}"
        for hold, s in zip(presence.holds(), presence.sets(), strict=True)
        for c, x in s.columns.items()
    ]
    return _long(clean.selectExpr(*centred), presence.sets(), columns)


def spearman(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rank correlation of all column pairs; ties share their mean rank.

    A pair is ranked over the rows where both columns are present. Pairs with the same presence condition share a
    ranking, and one ordering of the distinct values serves all rankings. The ranks of all columns come back to their
    rows in one join of (column, value) cells and one grouping by row, however many columns there are. Rows are dealt
    to as many tasks as their cells are worth, so that the memory of a task does not grow with them.
    """
    columns = list(columns)
    clean = _numbers(df, columns)
    presence = _Presence.of(clean, len(columns))
    holds = dict(enumerate(presence.holds()))
    # Stored, so that the row numbers are the same in every pass.
    clean = materialize(
        clean.withColumn("_row", F.monotonically_increasing_id()).selectExpr("*", *[f"{h} AS holds{i}" for i, h in holds.items()]),
        "numbered-columns",
    )
    parts = max(math.ceil(clean.count() * len(columns) / TASK_CELLS), int(clean.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    cells = ", ".join(f"struct({c} AS column, c{c} AS value)" for c in range(len(columns)))

    def long(rows: DataFrame) -> DataFrame:
        return rows.selectExpr("_row", *[f"holds{i}" for i in holds], f"inline(array({cells}))").where("value IS NOT NULL")

    counts = long(clean).groupBy("column", "value").agg(*[F.expr(f"count_if(holds{i}) AS n{i}") for i in holds])
    counts = materialize(counts, "value-counts")
    running = running_totals(counts, ["column", "value"], {f"upto{i}": f"n{i}" for i in holds})
    starts = running.groupBy("column").agg(
        *[F.expr(f"min(upto{i} - n{i}) AS start{i}") for i in holds], *[F.expr(f"sum(n{i}) AS all{i}") for i in holds]
    )
    placed = running.join(F.broadcast(starts), "column")  # starts: one row per column of the matrix
    # Less the middle rank of the column, which keeps the sums of products small.
    centred = [f"upto{i} - start{i} - (n{i} - 1) / 2 - (all{i} + 1) / 2 AS rank{i}" for i in holds]
    ranks = placed.selectExpr("column", "value", *centred)
    known = BroadcastBudget(RANK_BYTES).sized(ranks, stored_bytes(counts))
    if known is not ranks:
        # The cells of a row stay together, so the rows are dealt once, before the join.
        ranked = long(clean.repartition(parts, "_row")).join(known, ["column", "value"])
    else:
        ranked = long(clean).repartition(parts, "column", "value").join(ranks, ["column", "value"]).repartition(parts, "_row")
    kept = [
        f"max(CASE WHEN column = {c} AND holds{i} THEN rank{i} END) AS {x}"
        for i, s in enumerate(presence.sets())
        for c, x in s.columns.items()
    ]
    return _long(ranked.groupBy("_row").agg(*[F.expr(k) for k in kept]), presence.sets(), columns)
