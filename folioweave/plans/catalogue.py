"""All registered queries and their SQL."""

from folioweave.plans import (  # noqa: F401
    queries_analysis, queries_chat, queries_corpus, queries_search, queries_sources, queries_text)
from folioweave.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
