"""All queries by name, and their SQL."""

from __future__ import annotations

from legispark.plans import on_bills, on_plans, on_tables, on_votes
from legispark.plans.bindings import QUERIES, SQL

__all__ = ["QUERIES", "SQL", "on_bills", "on_plans", "on_tables", "on_votes"]
