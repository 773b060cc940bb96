"""Registry of driver queries: key -> (Spark plan builder, DuckDB oracle SQL).

Every query reads the driver tables of ``sf_dir`` through the canonical
bindings, so its work grows with the data.  Keys without oracle SQL are
checked rows-only by the driver and against brute force in the tests.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from martlake.sources.bindings import RetailSources, bind_sources
from martlake.sources.silver import to_silver


@dataclass
class Query:
    key: str
    build: Callable[[SparkSession, str], DataFrame]
    sql: str | None
    doc: str = ""


REGISTRY: dict[str, Query] = {}


def silver(spark: SparkSession, sf_dir: str) -> RetailSources:
    return to_silver(bind_sources(spark, sf_dir))


def query(key: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir) -> DataFrame`` under ``key``."""
    def deco(fn):
        REGISTRY[key] = Query(key, fn, sql, (fn.__doc__ or "").strip())
        return fn
    return deco


def load_all() -> dict[str, Query]:
    # Importing the modules registers their queries.
    from martlake.plans import (  # noqa: F401
        q_core, q_quality, q_profile, q_analysis, q_concentration, q_bootstrap, q_gates)
    return REGISTRY
