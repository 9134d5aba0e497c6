"""Query catalogue: name, builder, operator ids it exercises, optional comparison SQL."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Query:
    name: str
    build: Callable[[SparkSession, str], DataFrame]
    covers: tuple[str, ...]
    sql: str | None


CATALOGUE: dict[str, Query] = {}


def query(covers: str, sql: str | None = None):
    """Registers a builder under its function name."""
    def add(fn):
        if fn.__name__ in CATALOGUE:
            raise ValueError(f"duplicate query {fn.__name__}")
        CATALOGUE[fn.__name__] = Query(fn.__name__, fn, tuple(covers.split()), sql.strip() if sql else None)
        return fn
    return add
