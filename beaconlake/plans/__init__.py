"""Registered queries over the driver's tables."""

from beaconlake.plans.tables import REGISTRY
from beaconlake.plans import feed_queries, orbit_queries, source_queries, text_queries, vessel_queries, view_queries  # noqa: F401

__all__ = ["REGISTRY"]
