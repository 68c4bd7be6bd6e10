"""Registry of queries."""

from __future__ import annotations

import importlib
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame

from strandlake.session import Tables

MODULES = ("select_filter", "joins", "aggregates", "windows", "scalars", "changes", "quality",
           "feature_jobs", "reads", "formats", "exports", "graphs", "diversity", "event_windows", "models")


@dataclass(frozen=True)
class Query:
    name: str
    operators: tuple[str, ...]
    run: Callable[[Tables], DataFrame]
    sql: str | None


_QUERIES: dict[str, Query] = {}


def query(name: str, operators: str, sql: str | None = None):
    """Register a function of ``Tables``; ``operators`` lists the inventory ids it shows."""

    def register(fn):
        if name in _QUERIES:
            raise ValueError(f"query {name} registered twice")
        _QUERIES[name] = Query(name, tuple(operators.split()), fn, sql)
        return fn

    return register


def all_queries() -> dict[str, Query]:
    for module in MODULES:
        importlib.import_module(f"strandlake.plans.{module}")
    return dict(_QUERIES)


def half_up(expr: str, places: int = 2) -> str:
    """SQL text of ``functions.numeric.half_up``."""
    factor = f"{10 ** places}.0::DOUBLE"
    return f"(floor(({expr})::DOUBLE * {factor} + 0.5::DOUBLE) / {factor})"


def exact_sum(expr: str, scale: int) -> str:
    return f"CAST(sum(CAST({expr} AS DECIMAL(18,{scale}))) AS DOUBLE)"


def exact_mean(expr: str, scale: int) -> str:
    return f"({exact_sum(expr, scale)} / nullif(count({expr}), 0))"
