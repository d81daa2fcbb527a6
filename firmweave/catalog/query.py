"""A named query and the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

Build = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    name: str
    build: Build
    sql: str | None = None


class QuerySet:
    """Collects the queries of one module."""

    def __init__(self) -> None:
        self.items: list[Query] = []

    def add(self, name: str, sql: str | None = None) -> Callable[[Build], Build]:
        def keep(build: Build) -> Build:
            self.items.append(Query(name, build, sql))
            return build

        return keep
