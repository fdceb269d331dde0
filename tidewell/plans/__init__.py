"""Registered queries over the test tables, with the SQL they must equal."""

from tidewell.plans import drift, recovery, rows, scans, state, tables, typed, values  # noqa: F401
from tidewell.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
