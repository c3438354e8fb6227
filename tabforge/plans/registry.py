"""Query catalog: named queries over the test tables and their SQL oracles.

Each catalog module registers ``name -> fn(spark, sf_dir) -> DataFrame`` and,
when the result is expressible in plain SQL, an independent ANSI SQL text
that DuckDB evaluates over the same parquet tables.  Column names are
aliased identically on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    """Decorator: add a query (and optionally its oracle SQL) to the catalog."""

    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query name {name!r}")
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return deco


CATALOG_MODULES = [
    "catalog_monitor",
    "catalog_clean",
    "catalog_metrics",
    "catalog_sampling",
    "catalog_model",
    "catalog_json",
    "catalog_synth",
    "catalog_runs",
    "catalog_sources",
    "catalog_streaming",
]


def load_catalog() -> None:
    """Import every catalog module so that its queries register."""
    import importlib

    for mod in CATALOG_MODULES:
        importlib.import_module(f"tabforge.plans.{mod}")
