"""Registered queries: each a Spark job on the derived views, most with an oracle in SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from cellweave.plans.fixtures import Tables, with_views

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, views: str = "", oracle: str | None = None):
    """Register ``f(tables) -> DataFrame``; ``views`` are the ones the oracle text uses."""

    def add(f: Callable[[Tables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = lambda spark, folder: f(Tables(spark, folder))
        if oracle is not None:
            ORACLES[name] = with_views(oracle, *views.split())
        return f

    return add


def load_all() -> None:
    from cellweave.plans import (  # noqa: F401
        queries_composite,
        queries_grid,
        queries_raster,
        queries_rows,
        queries_vector,
    )
