"""A list of queries, each beside the SQL it is compared with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


class Pairs:
    def __init__(self) -> None:
        self.queries: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
        self.sql: dict[str, str] = {}

    def add(self, name: str, query: Callable[[SparkSession, str], DataFrame], sql: str) -> None:
        if name in self.queries:
            raise ValueError(f"{name} is registered twice")
        self.queries[name] = query
        self.sql[name] = sql
