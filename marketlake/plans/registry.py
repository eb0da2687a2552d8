"""Registered queries over the driver tables, each with its DuckDB oracle.

Every query reads whole tables (or data Spark derives from them); none caps,
samples or slices rows.  Column names are aliased identically on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql.strip()
        return fn
    return deco


def load_all() -> None:
    """Import the modules that register queries."""
    from marketlake.plans import q_marts, q_rows, q_shape, q_calendar, q_tables, q_more, q_stored, q_files, q_ingest  # noqa: F401
