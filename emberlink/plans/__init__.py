"""Queries over the given tables; importing this package registers all of them."""

from emberlink.plans import articles, links, reports, sources, streams  # noqa: F401
from emberlink.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
