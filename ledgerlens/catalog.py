"""Every query by name, with the SQL that must give the same rows."""

from __future__ import annotations

from .queries import blocks, deltas, features, graph, names, reuse, scalars, scan, streams, training  # noqa: F401  they register themselves
from .queries.registry import ORACLE_SQL, QUERIES

__all__ = ["ORACLE_SQL", "QUERIES"]
