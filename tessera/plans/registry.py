"""Query registry: one entry per operator ID of the inventory.

A query is a function ``(spark, sf_dir) -> DataFrame``.  The oracle is SQL
text runnable by DuckDB over the driver tables, or ``None`` when the
operator is not expressible in SQL (model fits, random sampling); those are
checked by own tests instead.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    name: str
    ids: tuple[str, ...]
    fn: QueryFn
    oracle: str | None
    headline: bool = False


REGISTRY: dict[str, Query] = {}


def query(name: str, ids: str | tuple[str, ...], oracle: str | None = None,
          headline: bool = False):
    """Decorator registering a query under ``name`` covering inventory ``ids``."""
    ids = (ids,) if isinstance(ids, str) else tuple(ids)

    def deco(fn: QueryFn) -> QueryFn:
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = Query(name, ids, fn, oracle, headline)
        return fn

    return deco


def load_all() -> dict[str, Query]:
    """Import every query module so that its decorators run."""
    from . import (q_core, q_profile, q_nulls, q_encode, q_scale, q_geo,  # noqa: F401
                   q_select, q_model, q_wrapper)
    return REGISTRY
