"""Affiliation resolution on Spark: which institute, and where, a free-text author affiliation means."""

from affilix.plans.collect import collect
from affilix.plans.resolve import attach_cached, resolve

__all__ = ["attach_cached", "collect", "resolve"]
