"""Name -> query and name -> DuckDB SQL for the library's own operators."""

from __future__ import annotations

from .plans import bonds, book, events, facts, filings, files, more, notes, packed, pages, series, stored, streams, texts, wholes  # noqa: F401  they register their queries
from .registry import ORACLE_SQL, QUERIES

__all__ = ["ORACLE_SQL", "QUERIES"]
