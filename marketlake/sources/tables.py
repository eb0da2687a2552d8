"""Table scans (S08) and parameterised SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, path: str, columns=None, where: str | None = None) -> DataFrame:
    """Scan a stored table; the column list and filter reach the Parquet
    reader (``ReadSchema`` / ``PushedFilters``)."""
    df = spark.read.parquet(path)
    if where:
        df = df.where(where)
    return df.select(*columns) if columns else df


def sql(spark: SparkSession, query: str, **params) -> DataFrame:
    """``sql_to_dataframe(query, vars)`` with named parameters
    (``WHERE tenant_id = :tenant``) bound by Spark, never formatted into text."""
    return spark.sql(query, args=params or None)
