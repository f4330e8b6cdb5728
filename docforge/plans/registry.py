"""Registry of named queries: a Spark callable ``(spark, sf_dir) -> DataFrame``
and, where the operator is expressible in SQL, an oracle query for DuckDB over
the same tables (fixture views are inlined as CTEs)."""

from __future__ import annotations

from collections.abc import Callable

from ..fixtures import duckdb_with

QUERIES: dict[str, Callable] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None, views: tuple[str, ...] = ()):
    """Register ``fn`` under ``name``; ``sql`` is the DuckDB body reading the
    fixture ``views``."""
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = duckdb_with(sql.strip(), *views)
        return fn
    return deco
