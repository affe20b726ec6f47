"""Registered queries: each runs an operator over the given tables, with SQL to compare."""

from broadsheet.plans.registered import activity, catalogue, facets, ingest, search, text, upkeep  # noqa: F401
from broadsheet.plans.registered.registry import REGISTRY, Query, Tables

__all__ = ["REGISTRY", "Query", "Tables"]
