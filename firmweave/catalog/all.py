"""The whole catalogue."""

from __future__ import annotations

from firmweave.catalog import model_queries, registry_queries, value_queries
from firmweave.catalog.query import Query

QUERIES: dict[str, Query] = {
    query.name: query
    for module in (value_queries, registry_queries, model_queries)
    for query in module.QUERIES.items
}
