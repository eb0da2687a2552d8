"""Aggregation helpers.

Everything is a ``groupBy().agg()`` with built-in aggregates, so Spark runs a
partial (map-side) aggregate before the shuffle and a final one after it: a hot
group is combined on every mapper and ships one row per partition.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def sum_metrics(df: DataFrame, by: Sequence, metrics: dict[str, Column], having: Column | None = None) -> DataFrame:
    """Grouped sums (any aggregate Column), optional HAVING."""
    out = df.groupBy(*by).agg(*[c.alias(n) for n, c in metrics.items()])
    return out.where(having) if having is not None else out


def pivot(df: DataFrame, rows: Sequence[str], column: str, value: str, values: Sequence | None = None,
          agg: str = "max") -> DataFrame:
    """A10: crosstab, one output column per ``column`` value; several values per
    cell are resolved by ``agg`` (max by default).  Pass ``values`` to avoid the
    extra job that discovers them (and to fix the output schema)."""
    g = df.groupBy(*rows).pivot(column, list(values) if values is not None else None)
    return getattr(g, agg)(value) if agg != "first" else g.agg(F.first(value))


def value_counts(df: DataFrame, cols: Sequence[str], name: str = "count") -> DataFrame:
    """Counts per distinct value (NULL is a value here too)."""
    return df.groupBy(*cols).agg(F.count(F.lit(1)).alias(name))


def null_audit(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """One row with ``rows`` and a NULL count per column (``isnull().sum()``)."""
    cols = list(cols or df.columns)
    return df.agg(F.count(F.lit(1)).alias("rows"),
                  *[F.sum(F.col(f"`{c}`").isNull().cast("bigint")).alias(f"null_{c}") for c in cols])


def duplicate_count(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows, distinct keys and the number of surplus (duplicate) rows."""
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(F.sum("n").alias("rows"), F.count(F.lit(1)).alias("keys"),
                       (F.sum("n") - F.count(F.lit(1))).alias("duplicates"))


def any_rows(df: DataFrame, n: int) -> DataFrame:
    """``LIMIT n`` sample, any rows (a feature limit: peeking at a table)."""
    return df.limit(n)
