"""Registry of named queries: a Spark builder and, where SQL can say it, the
equivalent DuckDB SQL over the same parquet tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

Builder = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    name: str
    build: Builder
    sql: str | None
    covers: str


REGISTRY: dict[str, Query] = {}


def register(name: str, sql: str | None, covers: str):
    def deco(fn: Builder) -> Builder:
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = Query(name, fn, sql, covers)
        return fn
    return deco
