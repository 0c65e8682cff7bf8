"""Registry of checked queries.

Each query is a function ``(spark, sf_dir) -> DataFrame`` registered under
DuckDB SQL formulation used as the correctness oracle (``None`` when the
operator is iterative or otherwise not expressible in SQL).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Query:
    name: str
    fn: Callable[[SparkSession, str], DataFrame]
    sql: str | None
    covers: tuple[str, ...]


REGISTRY: dict[str, Query] = {}


def query(name: str, sql: str | None = None, covers: tuple[str, ...] = ()):
    def deco(fn):
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = Query(name, fn, sql, tuple(covers))
        return fn
    return deco


def load_all() -> dict[str, Query]:
    # Importing the query modules fills the registry.
    from tessera.plans import (  # noqa: F401
        q_composite, q_catalogue, q_grid, q_orders, q_objects, q_misc, q_pipeline, q_sinks, q_workflow)
    return REGISTRY
