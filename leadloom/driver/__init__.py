"""Queries over the driver tables, each with the SQL that must give the same rows."""

from leadloom.driver import dedup, identity, leads, runs, sources, state, text  # noqa: F401
from leadloom.driver.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
