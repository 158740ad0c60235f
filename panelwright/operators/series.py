"""Windows over the rows of one series: expanding means, shifts, rolling means.

A series whose length is bounded (``PanelSpec.max_rows``) is handled by an ordinary window: one shuffle and one sort
serve all expressions. A series of unknown length may hold any share of the rows. Its rows are numbered over a global
order and cut by their number into blocks of bounded size; each block continues from the totals of the blocks before
it, or sees copies of the neighbouring rows its frames reach.

A row with a NULL key or period belongs to no series: it stays, and its results are NULL. Both ways give the same rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelwright.functions.columns import ratio
from panelwright.functions.names import quoted
from panelwright.operators.ordering import row_ranks
from panelwright.spec import PanelSpec
from panelwright.storage import materialize

# Rows of one series that a single task may sort and scan.
SERIES_ROWS = 1_000_000

_ROW, _BLOCK, _PLACED, _RANK = "_row", "_block", "_placed", "_rank"


def is_bounded(spec: PanelSpec) -> bool:
    return spec.max_rows is not None and spec.max_rows <= SERIES_ROWS


def _names(names: Sequence[str]) -> list[str]:
    return [quoted(n) for n in names]


def _present(spec: PanelSpec, keys: Sequence[str]) -> str:
    return " AND ".join(f"{quoted(c)} IS NOT NULL" for c in (*keys, spec.time))


def _within(spec: PanelSpec, keys: Sequence[str]) -> str:
    """A window over a series in order; rows without a period come last."""
    return f"PARTITION BY {', '.join(_names(keys))} ORDER BY {quoted(spec.time)} NULLS LAST, {quoted(spec.id)}"


def _numbered(df: DataFrame, spec: PanelSpec, keys: Sequence[str]) -> DataFrame:
    """Number the rows of every series 1, 2, ... without a window over a whole series, and store them.

    Rows that belong to no series have no number.
    """
    placed = df.withColumn(_PLACED, F.expr(_present(spec, keys)))
    ranked = materialize(row_ranks(placed, [_PLACED, *_names(keys), quoted(spec.time), quoted(spec.id)], _RANK), "numbered")
    valid = ranked.where(_PLACED)
    named = [F.col(k).alias(f"_key{i}") for i, k in enumerate(_names(keys))]
    starts = valid.groupBy(*named).agg(F.min(_RANK).alias("_start"))
    same = [F.col(k) == F.col(f"_key{i}") for i, k in enumerate(_names(keys))]
    own = valid.join(starts, same).select(*_names(df.columns), (F.col(_RANK) - F.col("_start") + 1).alias(_ROW))
    return own.unionByName(ranked.where(~F.col(_PLACED)).select(*_names(df.columns), F.lit(None).cast("bigint").alias(_ROW)))


def expanding_means(
    df: DataFrame,
    spec: PanelSpec,
    columns: dict[str, str],
    extra_keys: Sequence[str] = (),
    block_rows: int = 100_000,
) -> DataFrame:
    """Mean of all rows of the series up to and including this one; ``columns`` maps output to input column.

    ``extra_keys`` split a series further, for example by promotion state.
    """
    keys = [*spec.keys, *extra_keys]
    if is_bounded(spec):
        over = f"OVER ({_within(spec, keys)} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
        means = [f"CASE WHEN {_present(spec, keys)} THEN avg({quoted(c)}) {over} END AS {quoted(o)}" for o, c in columns.items()]
        return df.selectExpr(*_names(df.columns), *means)
    names = list(dict.fromkeys(columns.values()))
    values = {c: F.col(quoted(c)).cast("double") for c in names}
    numbered = materialize(_numbered(df, spec, keys), "numbered-rows")
    cut = numbered.withColumn(_BLOCK, F.floor((F.col(_ROW) - 1) / block_rows))
    by = [F.col(k) for k in _names(keys)]
    totals = cut.where(F.col(_ROW).isNotNull()).groupBy(*[k.alias(f"_key{i}") for i, k in enumerate(by)], _BLOCK).agg(
        *[F.sum(v).alias(f"_sum{j}") for j, v in enumerate(values.values())],
        *[F.count(v).alias(f"_n{j}") for j, v in enumerate(values.values())],
    )
    named = [f"_key{i}" for i in range(len(keys))]
    earlier = Window.partitionBy(*named).orderBy(_BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    facts = [f"_{kind}{j}" for kind in ("sum", "n") for j in range(len(names))]
    starts = totals.select(
        *named, F.col(_BLOCK).alias("_of"), *[F.coalesce(F.sum(f).over(earlier), F.lit(0)).alias(f"_start{f}") for f in facts]
    )
    # Rows outside any series match no start and keep NULL results.
    same = [k == F.col(n) for k, n in zip(by, named, strict=True)] + [F.col(_BLOCK) == F.col("_of")]
    joined = cut.join(starts, same, "left")
    w = Window.partitionBy(*by, _BLOCK).orderBy(_ROW).rowsBetween(Window.unboundedPreceding, 0)
    upto = {
        c: F.when(
            F.col(_ROW).isNotNull(),
            ratio(
                F.col(f"_start_sum{j}") + F.coalesce(F.sum(v).over(w), F.lit(0.0)),
                F.col(f"_start_n{j}") + F.count(v).over(w),
            ),
        )
        for j, (c, v) in enumerate(values.items())
    }
    return joined.select(*_names(df.columns), *[upto[c].alias(out) for out, c in columns.items()])


def row_numbers(df: DataFrame, spec: PanelSpec, out: str) -> DataFrame:
    """Number the rows of every series 1, 2, ... by time."""
    if is_bounded(spec):
        number = f"CASE WHEN {_present(spec, spec.keys)} THEN cast(row_number() OVER ({_within(spec, spec.keys)}) AS bigint) END"
        return df.selectExpr(*_names(df.columns), f"{number} AS {quoted(out)}")
    return _numbered(df, spec, spec.keys).withColumnRenamed(_ROW, out)


def density(df: DataFrame, spec: PanelSpec, out: str) -> DataFrame:
    """Rows of the series so far divided by the period number."""
    numbered = row_numbers(df, spec, _ROW)
    return numbered.withColumn(out, ratio(F.col(_ROW), F.col(quoted(spec.time)))).drop(_ROW)


def expanding_means_by_state(
    df: DataFrame,
    spec: PanelSpec,
    column: str,
    states: dict[str, tuple[str, ...]],
    block_rows: int = 100_000,
) -> DataFrame:
    """Expanding means of one column by series and state; ``states`` maps output column to state columns.

    All state splits refine the series key, so one shuffle by series serves every one of them.
    """
    for out, extra in sorted(states.items(), key=lambda s: len(s[1])):
        df = expanding_means(df, spec, {out: column}, extra, block_rows)
    return df


@dataclass(frozen=True)
class Frame:
    """Mean of ``column`` over the ``window`` rows that end ``step`` rows from the current one.

    A negative step looks back, a positive one ahead. Only rows at least ``step`` rows after the start of the series
    enter the mean, because shifting the series ahead discards them before averaging. With ``full`` the mean is NULL
    unless all ``window`` rows are present and valid.
    """

    column: str
    step: int
    window: int = 1
    full: bool = False

    def sql(self, window: str, time: str) -> str:
        """The mean as SQL over a window given as ``PARTITION BY ... ORDER BY ...``; rows without a period have no value."""
        column = f"CASE WHEN {quoted(time)} IS NOT NULL THEN {quoted(self.column)} END"
        if self.window == 1:
            moved = f"lag({column}, {-self.step})" if self.step < 0 else f"lead({column}, {self.step})"
            return f"cast({moved} OVER ({window}) AS double)"
        value = f"CASE WHEN {_ROW} > {self.step} THEN {column} END" if self.step > 0 else column
        ends = [_row_bound(self.step - self.window + 1), _row_bound(self.step)]
        over = f"OVER ({window} ROWS BETWEEN {ends[0]} AND {ends[1]})"
        mean = f"avg({value}) {over}"
        return f"CASE WHEN count({value}) {over} = {self.window} THEN {mean} END" if self.full else mean


def _row_bound(offset: int) -> str:
    return "CURRENT ROW" if offset == 0 else f"{abs(offset)} {'PRECEDING' if offset < 0 else 'FOLLOWING'}"


def add_frames(df: DataFrame, spec: PanelSpec, frames: dict[str, Frame], block_rows: int = 100_000) -> DataFrame:
    """Add one column per frame, counted in rows of the series and not in periods."""
    present = _present(spec, spec.keys)
    bounded = is_bounded(spec)
    needs_row = not bounded or any(f.step > 0 and f.window > 1 for f in frames.values())
    numbered = row_numbers(df, spec, _ROW) if needs_row else df
    if bounded:
        w = _within(spec, spec.keys)
        wide = [f"CASE WHEN {present} THEN {f.sql(w, spec.time)} END AS {quoted(out)}" for out, f in frames.items()]
        return numbered.selectExpr(*_names(df.columns), *wide)
    back = max(max(f.window - 1 - f.step, 0) for f in frames.values())
    ahead = max(max(f.step, 0) for f in frames.values())
    home = F.floor((F.col(_ROW) - 1) / block_rows)
    first = F.floor(F.greatest(F.col(_ROW) - 1 - ahead, F.lit(0)) / block_rows)
    last = F.floor((F.col(_ROW) - 1 + back) / block_rows)
    # A row outside any series has no blocks and is kept as it is.
    blocks = numbered.withColumn("_home", home).withColumn(_BLOCK, F.explode_outer(F.sequence(first, last)))
    w = f"PARTITION BY {', '.join((*_names(spec.keys), _BLOCK))} ORDER BY {_ROW}"
    wide = blocks.selectExpr("*", *[f"CASE WHEN {_ROW} IS NOT NULL THEN {f.sql(w, spec.time)} END AS {quoted(out)}" for out, f in frames.items()])
    return wide.where(F.col(_BLOCK).eqNullSafe(F.col("_home"))).select(*_names(df.columns), *_names(frames))


def rolling_deviation(df: DataFrame, spec: PanelSpec, column: str, window: int, out: str) -> DataFrame:
    """Value minus the mean of the last ``window`` rows; NULL until the series has that many valid rows."""
    wide = add_frames(df, spec, {"_mean": Frame(column, 0, window, full=True)})
    present = F.expr(_present(spec, spec.keys))
    return wide.withColumn(out, F.when(present, F.col(quoted(column)) - F.col("_mean"))).drop("_mean")
