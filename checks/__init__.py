"""Queries over the given tables and the SQL that must give the same rows."""

from checks import arrays, compare, kept, maps, reduce, select, sqlviews, temporal

_PARTS = (arrays, select, reduce, maps, temporal, compare, sqlviews, kept)

QUERIES = {name: fn for part in _PARTS for name, fn in part.QUERIES.items()}
ORACLE = {name: sql for part in _PARTS for name, sql in part.ORACLE.items()}
