"""Registered queries: one per operator, with the SQL that must agree with it."""

from catalog.registry import ORACLES, QUERIES
from catalog import corpus, text, encoding, batches, quality, tables, edges  # noqa: F401, I001  (registration)

__all__ = ["ORACLES", "QUERIES"]
