"""Demand-panel analytics on Spark DataFrames."""

from panelwright.spec import PanelSpec

__all__ = ["PanelSpec"]
