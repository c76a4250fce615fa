"""All queries and their SQL."""

from __future__ import annotations

from lexloom.plans import curation, evaluation, files, more, rows
from lexloom.plans.registry import ORACLE_SQL, QUERIES

__all__ = ["ORACLE_SQL", "QUERIES", "curation", "evaluation", "files", "more", "rows"]
