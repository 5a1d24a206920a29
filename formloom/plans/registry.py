"""Queries by name, each with the SQL that states the same rows."""

from __future__ import annotations

from . import drawing  # noqa: F401  registers its queries
from .queries import QUERIES, SQL

__all__ = ["FLAGSHIP", "QUERIES", "SQL"]

FLAGSHIP = "precedent_match"
