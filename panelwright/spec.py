"""Column roles of a demand panel."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class PanelSpec:
    """Which columns of a panel mean what.

    ``keys`` name a series, ``time`` is an integer period, ``id`` is unique per row and ``target`` is forecast.
    ``max_rows`` is a proven upper bound on the rows of one series, such as the number of periods of a panel with
    one row per series and period. Leave it None when no bound is known: series operators then cut every series
    into pieces instead of handling it in one task.
    """

    keys: tuple[str, ...]
    time: str
    id: str
    target: str
    max_rows: int | None = None
