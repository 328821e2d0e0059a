"""Query registry: name -> (Spark builder, DuckDB oracle SQL or None)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Builder = Callable[[SparkSession, str], DataFrame]

REGISTRY: dict[str, tuple[Builder, str | None]] = {}


def query(name: str, oracle: str | None = None):
    """Register a query builder with its oracle SQL."""
    def deco(fn: Builder) -> Builder:
        if name in REGISTRY:
            raise KeyError(f"duplicate query {name}")
        REGISTRY[name] = (fn, oracle)
        return fn
    return deco


def load_all() -> dict[str, tuple[Builder, str | None]]:
    # Importing the modules registers their queries.
    from carelake.plans import (q_claims, q_encounters, q_rx, q_patients, q_dims,  # noqa: F401
                                q_quality, q_reports, q_scoring, q_graph, q_ops, q_stream,
                                q_io, q_rules)
    return REGISTRY
