"""Registered queries and the SQL that states the same result."""

from __future__ import annotations

from tidepanel.catalog import registry
from tidepanel.catalog import (  # noqa: F401  (each module registers its queries)
    diagnostics, models, profiles, scoring, series, sources, spatial, streams, target,
)

QUERIES = registry.QUERIES
ORACLE = registry.ORACLE
