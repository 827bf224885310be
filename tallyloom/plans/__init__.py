"""Named queries over the test tables, each with the SQL it must agree with."""

from .catalogue import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
