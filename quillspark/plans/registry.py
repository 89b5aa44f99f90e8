"""Registers queries with the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]


class Registry:
    def __init__(self):
        self.queries: dict[str, Query] = {}
        self.oracle_sql: dict[str, str] = {}

    def query(self, sql: str | None = None) -> Callable[[Query], Query]:
        """Register a function under its own name; without SQL, tests hold it against a plain model."""

        def add(f: Query) -> Query:
            self.queries[f.__name__] = f
            if sql:
                self.oracle_sql[f.__name__] = sql
            return f

        return add
