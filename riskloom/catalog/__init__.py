"""Named queries over the sample tables, each with the SQL that gives the same rows."""

from riskloom.catalog import aml, analytics, layout, marketplace, payment, quality, sources, streams  # noqa: F401
from riskloom.catalog.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
