"""All queries over the test tables, and their SQL where SQL can express them."""

from __future__ import annotations

from . import q_changes, q_rows, q_schema, q_sources, q_strategies

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}
for _module in (q_strategies, q_rows, q_schema, q_changes, q_sources):
    QUERIES |= _module.QUERIES
    ORACLE_SQL |= _module.ORACLE_SQL
