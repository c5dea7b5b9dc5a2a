"""The queries of this subpackage, by name, and their SQL twins."""

from __future__ import annotations

from collatio.llm import queries as _q

QUERIES = _q.QUERIES
ORACLES = _q.ORACLES
