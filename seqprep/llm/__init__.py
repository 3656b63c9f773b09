"""Operators of a training-data pipeline. Nothing else in the library imports them."""

from seqprep.llm.registry import ORACLES, QUERIES
from seqprep.llm import queries  # noqa: F401, I001  (registration)

__all__ = ["ORACLES", "QUERIES"]
