"""Registered queries: every operator bound to the standard tables, with an equal SQL text."""

from frostline.registry import ensembles, files, grids, ingest, labels, series  # noqa: F401  (registration)
from frostline.registry.base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
