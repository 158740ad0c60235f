"""Lag plans: which rows before and after the last observed one become features, and how they are averaged."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame

from panelwright.functions.names import quoted
from panelwright.operators.series import Frame, add_frames
from panelwright.spec import PanelSpec


@dataclass(frozen=True)
class LagSpec:
    """Lag setting of one forecast horizon.

    The row to forecast is at position 0 and the last observed one at ``istep`` (negative). ``observed`` columns are
    known up to ``istep``, ``known`` ones up to ``t_max``, ``stats`` columns are taken at ``istep`` only. A window
    grows with the distance from the forecast as (distance + 1) ** ``power``.
    """

    istep: int
    t_min: int
    t_max: int
    power: float
    observed: tuple[str, ...] = ()
    known: tuple[str, ...] = ()
    stats: tuple[str, ...] = ()

    @property
    def horizon(self) -> int:
        return -self.istep

    @property
    def gap(self) -> int:
        """Periods left out between training and forecasting."""
        return -1 - self.istep


def lag_plan(t_min: int, t_max: int, istep: int, tstep: int, power: float) -> list[tuple[int, int]]:
    """Tile the time between ``t_min`` (left out) and ``t_max`` with (step, window) pairs, outward from ``istep``.

    Windows never overlap. Position 0, the forecast itself, is skipped.
    """
    if t_max > tstep + istep:
        raise ValueError(f"t_max {t_max} lies after the last known position {tstep + istep}")
    if t_min > t_max:
        raise ValueError(f"t_min {t_min} lies after t_max {t_max}")

    def width(position: int) -> int:
        return int((abs(position) + 1) ** power)

    tiles, position = [], istep
    while position > t_min:
        tiles.insert(0, (position, width(position)))
        position -= width(position)
    position = istep
    while position + width(position + 1) <= t_max:
        window = width(position + 1)
        position += window
        tiles.append((position, window))
    return [(step, window) for step, window in tiles if step != 0 and t_min <= step <= t_max]


def lag_name(column: str, step: int, window: int) -> str:
    """Column name such as ``price_3n2``: three rows back, mean of two; ``p`` means ahead."""
    return f"{column}_{abs(step)}{'n' if step < 0 else 'p'}{window}"


def lag_names(column: str, t_min: int, t_max: int, istep: int, tstep: int, power: float) -> list[str]:
    return [lag_name(column, s, w) for s, w in lag_plan(t_min, t_max, istep, tstep, power)]


def lag_frames(spec: LagSpec, tstep: int) -> dict[str, Frame]:
    """All lag columns of a setting, by name."""
    frames = {}
    for columns, t_min, t_max, power in (
        (spec.observed, spec.t_min, spec.istep, spec.power),
        (spec.known, spec.t_min, spec.t_max, spec.power),
        (spec.stats, spec.istep - 1, spec.istep, 0.0),
    ):
        for column in columns:
            for step, window in lag_plan(t_min, t_max, spec.istep, tstep, power):
                frames[lag_name(column, step, window)] = Frame(column, step, window)
    return frames


def lag_groups(spec: LagSpec, tstep: int) -> dict[str, list[str]]:
    """Lag columns of every known column, the groups that feature selection adds or removes together."""
    return {c: list(lag_frames(replace(spec, observed=(), stats=(), known=(c,)), tstep)) for c in spec.known}


def add_lags(df: DataFrame, panel: PanelSpec, specs: Sequence[LagSpec], tstep: int, **blocks: int) -> DataFrame:
    """Add the lag columns of all settings at once; columns that several settings share are computed once.

    A lag of the time column is the age of the lagged row: the current period minus the averaged one.
    """
    frames = {name: frame for spec in specs for name, frame in lag_frames(spec, tstep).items()}
    if not frames:
        return df
    wide = add_frames(df, panel, frames, **blocks)
    ages = {n for n, f in frames.items() if f.column == panel.time}
    return wide.selectExpr(*[f"{quoted(panel.time)} - {quoted(c)} AS {quoted(c)}" if c in ages else quoted(c) for c in wide.columns])
