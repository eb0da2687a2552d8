"""Set operations."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def union_distinct(*dfs: DataFrame) -> DataFrame:
    """SQL ``UNION``: positional, names from the first input, duplicates removed
    (one shuffle; partial distinct runs map-side)."""
    return reduce(lambda a, b: a.union(b), dfs).distinct()


def union_all(*dfs: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.union(b), dfs)


def pad_to(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select ``schema``'s columns in order; absent ones become typed NULLs."""
    have = set(df.columns)
    return df.select(*[(F.col(f.name).cast(f.dataType) if f.name in have
                        else F.lit(None).cast(f.dataType)).alias(f.name) for f in schema.fields])


def union_by_name(*dfs: DataFrame) -> DataFrame:
    """``pd.concat(ignore_index=True)``: by name, missing columns → NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)


def missing_dates(expected: DataFrame, loaded: DataFrame, col: str, loaded_col: str | None = None) -> DataFrame:
    """Requested dates that are not loaded yet (calendar anti join).
    ``loaded`` is reduced to its distinct dates first so the join input is tiny."""
    lc = loaded_col or col
    have = loaded.select(F.to_date(F.col(lc)).alias("__d")).distinct()
    return expected.join(have, F.to_date(F.col(col)) == F.col("__d"), "left_anti")
