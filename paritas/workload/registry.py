"""Registry of queries and their SQL twins.

A twin is plain SQL over the given tables. Shared subqueries are named ``c_...`` in
``sqlparts`` and are put in front of the statements that mention them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
TWINS: dict[str, str] = {}


def query(key: str, twin: str | None = None) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        if key in QUERIES:
            raise ValueError(f"query {key} registered twice")
        QUERIES[key] = fn
        if twin is not None:
            from .sqlparts import with_parts

            TWINS[key] = with_parts(twin)
        return fn

    return add
