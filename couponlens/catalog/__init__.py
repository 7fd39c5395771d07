"""The operators applied to the driver tables, and the DuckDB SQL that each result is checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]


class Catalog:
    """Named queries of one family with their oracle SQL."""

    def __init__(self) -> None:
        self.queries: dict[str, Query] = {}
        self.oracles: dict[str, str] = {}

    def add(self, key: str, sql: str) -> Callable[[Query], Query]:
        def register(query: Query) -> Query:
            if key in self.queries:
                raise ValueError(f"query {key} is registered twice")
            self.queries[key], self.oracles[key] = query, sql
            return query

        return register
