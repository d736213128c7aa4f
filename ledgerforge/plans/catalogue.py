"""All queries of the core with their SQL."""

from __future__ import annotations

from ledgerforge.plans import checks, ordered, printed, relations, scalars, streams
from ledgerforge.plans.registry import Query

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}
for _module in (scalars, checks, ordered, printed, relations, streams):
    QUERIES.update(_module.query.queries)
    SQL.update(_module.query.sql)
