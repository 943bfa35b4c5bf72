"""Operators run over the supplied tables, each with SQL that gives the same result.

The tables stand in for flights, weather and news: SURVEY section 7.3 names the roles.
"""

from skyloom.checks.base import QUERIES, SQL
from skyloom.checks import cleaning, context, formats, model, remaining, requests, scalars, traffic  # noqa: F401

__all__ = ["QUERIES", "SQL"]
