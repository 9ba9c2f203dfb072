"""The registered queries, by theme; importing this package registers them."""

from starloom.plans.queries import (  # noqa: F401
    dimensions,
    facts,
    incremental,
    places,
    quality,
    reports,
    shaping,
    tables,
    warehouse,
)
from starloom.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
