"""Registered queries over the benchmark tables, each with the SQL that must give the same rows."""

from affilix.catalog import jobs, matching, relational  # noqa: F401  (registering)
from affilix.catalog.register import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
