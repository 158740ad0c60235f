"""Queries over the driver's tables, one for every operator."""

from catalog import companions, features, models, profiles, scores, tables  # noqa: F401
from catalog.base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
