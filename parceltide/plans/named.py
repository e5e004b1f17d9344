"""Named queries over the store with optional filters, as the tool interface asks for them."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from typing import Any

from pyspark.sql import DataFrame

from parceltide import constants as K
from parceltide.operators import shaping, store_queries as Q
from parceltide.plans.store import Store
from parceltide.streaming.tower import TowerTables

_FILTERS = ("hub_id", "client_id", "severity", "status", "limit")

# name -> (query, filters it understands); other known filters are accepted and ignored
_QUERIES: dict[str, tuple[Callable[..., DataFrame], tuple[str, ...]]] = {
    "delayed_parcels": (
        lambda s, **f: Q.delayed_parcels(s.state, **f),
        ("hub_id", "client_id", "status", "limit"),
    ),
    "at_risk_parcels": (
        lambda s, **f: Q.at_risk_parcels(s.state, **f),
        ("hub_id", "client_id", "status", "limit"),
    ),
    "hub_stats": (lambda s, **f: Q.hub_stats(s.state, **f), ("limit",)),
    "route_stats": (lambda s, **f: Q.route_stats(s.state, **f), ("limit",)),
    "recent_alerts": (
        lambda s, **f: Q.recent_alerts(s.alerts, s.state, periods=s.periods("alerts"), **f),
        ("severity", "limit"),
    ),
    "client_parcels": (
        lambda s, **f: Q.client_parcels(s.state, **f), ("client_id", "status", "limit"),
    ),
    "kpi_summary": (lambda s: Q.kpi_summary(s.state), ()),
    "parcels_by_status": (lambda s, **f: Q.parcels_by_status(s.state, **f), ("limit",)),
}


def named_queries() -> list[str]:
    return list(_QUERIES)


def run_named_query(store: Store | TowerTables, name: str,
                    filters: Mapping[str, Any] | None = None) -> DataFrame:
    """Run a query by name, over a built store or what a stream has published, and return JSON-safe columns. Unknown names raise ``KeyError``."""
    if name not in _QUERIES:
        raise KeyError(f"unknown query: {name}; known: {', '.join(_QUERIES)}")
    query, understood = _QUERIES[name]
    given = {key: value for key, value in (filters or {}).items() if value is not None}
    unknown = set(given) - set(_FILTERS)
    if unknown:
        raise KeyError(f"unknown filters: {', '.join(sorted(unknown))}")
    arguments = {key: value for key, value in given.items() if key in understood}
    if "limit" in understood:
        arguments["limit"] = int(arguments.get("limit", K.DEFAULT_LIMIT))
    return shaping.normalise_result(query(store, **arguments))
