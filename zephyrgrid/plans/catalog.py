"""Importing this module registers every query."""

from . import (  # noqa: F401
    adjust_queries,
    aggregate_queries,
    model_queries,
    scalar_queries,
    spatial_queries,
    storage_queries,
)
from .registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
