"""All registered queries; importing a module registers its queries."""

from lakeloom.queries import lineage, columns, relational, calendar, history, checks, layers  # noqa: F401
from lakeloom.queries import storage, streams  # noqa: F401
from lakeloom.queries.base import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
