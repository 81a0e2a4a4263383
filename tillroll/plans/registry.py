"""Registry of named queries and their independent SQL oracles.

A query is ``fn(spark, root) -> DataFrame`` over the tables under ``root``;
its oracle is DuckDB SQL over the same tables, written separately (it shares
no code with the Spark side).  Query ids follow the operator inventory.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..sources.tables import Tables

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def deco(fn: Callable[[Tables], DataFrame]) -> QueryFn:
        def run(spark: SparkSession, root: str) -> DataFrame:
            return fn(Tables(spark, root))
        run.__name__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if oracle is not None:
            ORACLES[name] = oracle
        return run
    return deco


def load_all() -> None:
    from . import (cleaning_queries, adapt_queries, segment_queries, cluster_queries,  # noqa: F401
                   feature_queries, model_queries, serving_queries)
