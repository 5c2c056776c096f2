"""All registered queries."""

from . import aggregated, basic, campus, changed, joined, landed  # noqa: F401
from .base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
