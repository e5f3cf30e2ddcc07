"""The registry of named queries with the inventory items they cover."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from plumbline.catalog.oracle import oracle


@dataclass(frozen=True)
class Query:
    name: str
    covers: tuple[str, ...]
    build: Callable[[SparkSession, str], DataFrame]
    sql: str | None


QUERIES: dict[str, Query] = {}


def query(covers: str, sql: str | None = None):
    """Registers a query function under its own name; ``sql`` is the checking query."""
    def register(build):
        name = build.__name__
        QUERIES[name] = Query(name, tuple(covers.split()), build, None if sql is None else oracle(sql))
        return build

    return register
