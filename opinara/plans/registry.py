"""Named queries and the SQL each one is checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from opinara.plans.oracle import with_inputs

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(slug: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Registers a query; without SQL only its rows are checked and a test compares it with brute force."""

    def add(build: Query) -> Query:
        if slug in QUERIES:
            raise ValueError(f"query {slug} is registered twice")
        QUERIES[slug] = build
        if sql is not None:
            ORACLES[slug] = with_inputs(sql)
        return build

    return add
