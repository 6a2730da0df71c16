"""The queries of the driver contract, each with its closed-form SQL where there is one."""

from workload import edits, features, geometry, stored, summaries
from workload.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "edits", "features", "geometry", "stored", "summaries"]
