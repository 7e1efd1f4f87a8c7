"""The engine's queries by name, and the SQL that checks them."""

from . import cells, changes, encoded, keysets, mapping, reconcile, scans, shapes, streams, texts

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}
for _part in (scans, encoded, keysets, shapes, mapping, changes, reconcile, streams, texts, cells):
    QUERIES |= _part.Q.queries
    ORACLE_SQL |= _part.Q.sql
