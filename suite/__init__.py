"""Queries over the driver's tables, each beside the SQL that must give the same rows."""

from suite import checks, frames, missing, models, plans, scalars, sources  # noqa: F401
from suite.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
