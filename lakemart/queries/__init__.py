"""Checked queries: every operator over whole tables, with the SQL that gives the same result."""

from lakemart.queries import arrays, jobs, relational, roundtrips, text  # noqa: F401
from lakemart.queries.registry import QUERIES, Tables

__all__ = ["QUERIES", "Tables"]
