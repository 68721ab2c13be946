"""Registry of the correctness suite: one Spark query per SURVEY §2 id, and
where the result is SQL-expressible, its DuckDB twin."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    """Decorator: ``fn(spark, sf_dir) -> DataFrame`` under ``name``; ``oracle``
    is the DuckDB SQL returning the same columns (omit for rows-only ids)."""
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query id {name}")
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return deco


def load_all() -> None:
    """Import the modules that register queries."""
    import importlib

    for mod in SUITE_MODULES:
        importlib.import_module(f"{__package__}.{mod}")


SUITE_MODULES = ["q_features", "q_prep", "q_profile", "q_metrics", "q_gates", "q_models", "q_sources", "q_catalog"]
