"""Named queries over the test tables, each with the SQL that checks it."""

from skygalley.registry.base import oracle_sql, queries

__all__ = ["oracle_sql", "queries"]
