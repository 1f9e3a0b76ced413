"""Registry of named queries and their independent SQL oracles."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]


@dataclass
class Entry:
    name: str
    fn: QueryFn
    sql: str | None
    covers: tuple[str, ...]


REGISTRY: dict[str, Entry] = {}


def query(name: str, covers: str = "", sql: str | None = None):
    """Register ``fn(spark, sf_dir) -> DataFrame`` under ``name``.

    ``sql`` is the DuckDB text over the driver's table views that must give
    the same rows; ``None`` marks an operator that SQL cannot express (ML,
    streaming, file metadata), which is then checked on row counts only.
    """
    def deco(fn: QueryFn) -> QueryFn:
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = Entry(name, fn, sql, tuple(c for c in covers.replace(",", " ").split() if c))
        return fn
    return deco
