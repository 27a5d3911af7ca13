"""Registry of named queries (operator ID -> Spark plan) and their DuckDB oracle SQL."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lineark.session import ship_package, shared_dir

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    """Register ``fn(spark, sf_dir) -> DataFrame`` under ``name``.

    ``oracle`` is ANSI SQL over the driver tables giving the same rows and
    column names; leave it out only where the result cannot be written in SQL.
    """
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")

        @functools.wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            shared_dir(spark)          # checkpoints and written tables need the shared folder
            ship_package(spark)        # Python workers import the operators' functions
            return fn(spark, sf_dir)

        QUERIES[name] = run
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return deco


def load_all() -> None:
    """Import every query module so that the registry is filled."""
    from lineark.plans import (  # noqa: F401
        q_series, q_scalars, q_requests, q_resolve, q_records, q_workflow, q_graph,
        q_arraymath, q_sources, q_udf, q_streaming,
    )
