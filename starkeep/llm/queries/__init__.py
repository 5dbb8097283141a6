"""One query for each operator of this package, over the whole of its table."""

from starkeep.llm.queries import copies, judging, searching, shaping  # noqa: F401
from starkeep.llm.queries.registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
