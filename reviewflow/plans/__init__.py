"""Named queries (one per operator of the inventory) and their oracle SQL."""

from . import etl, lifecycle, prep, requests, sampling, streams, text_model  # noqa: F401  (each module registers its queries)
from .registry import ORACLE, QUERIES

__all__ = ["QUERIES", "ORACLE"]
