"""Queries over the sample tables, each with the SQL that must give the same rows."""

from starkeep.queries import (
    building,
    cleaning,
    lookups,
    merging,
    quality,
    reporting,
    seeding,
    storing,
)
from starkeep.queries.registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
