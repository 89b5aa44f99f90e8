"""Every query of the engine by name, with the SQL that it is held against."""

from __future__ import annotations

from . import chunks, monitoring, pages, search, streams, texts, upkeep
from .registry import Query

_PARTS = [m.REGISTRY for m in (search, monitoring, texts, chunks, pages, streams, upkeep)]
QUERIES: dict[str, Query] = {k: q for p in _PARTS for k, q in p.queries.items()}
ORACLE_SQL: dict[str, str] = {k: q for p in _PARTS for k, q in p.oracle_sql.items()}
