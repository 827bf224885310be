"""Imports every group of queries, so that all of them are registered."""

from . import evaluation, exploration, features, learning, regression, relational  # noqa: F401
from .registration import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
