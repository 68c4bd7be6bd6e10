"""Registered queries: each binds operators to the given tables, with equivalent SQL where one exists."""

from strandlake.plans.registry import all_queries

__all__ = ["all_queries"]
