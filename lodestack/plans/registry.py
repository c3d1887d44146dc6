"""The registered queries of the library."""

from __future__ import annotations

from . import catalogs, integrity, pointers, reads, scalars, streams  # noqa: F401 - they register their queries
from .reference import ORACLE_SQL, QUERIES, flagship

__all__ = ["ORACLE_SQL", "QUERIES", "flagship"]
