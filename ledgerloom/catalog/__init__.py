"""Registered queries, each beside the SQL that states its result independently."""

from ledgerloom.catalog.registry import oracles, queries

__all__ = ["oracles", "queries"]
