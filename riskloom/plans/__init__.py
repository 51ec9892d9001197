"""Named queries over the shared tables and their DuckDB oracle SQL."""

from riskloom.plans.registry import ORACLE, QUERIES, load_all  # noqa: F401
