"""Small dimensions (S13, S14) and schema introspection."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlake.operators.joins import broadcast_if_small

# --- fixed values that must equal the reference's -----------------------------
# Selling-partner marketplaces: (marketplace_name, endpoint, marketplace_id, region).
_EU = "https://sellingpartnerapi-eu.amazon.com"
_FE = "https://sellingpartnerapi-fe.amazon.com"
_NA = "https://sellingpartnerapi-na.amazon.com"
MARKETPLACES = [
    ("AE", _EU, "A2VIGQ35RCS4UG", "eu-west-1"),
    ("BE", _EU, "AMEN7PMS3EDWL", "eu-west-1"),
    ("DE", _EU, "A1PA6795UKMFR9", "eu-west-1"),
    ("PL", _EU, "A1C3SOZRARQ6R3", "eu-west-1"),
    ("EG", _EU, "ARBP9OOSHTCHU", "eu-west-1"),
    ("ES", _EU, "A1RKKUPIHCS9HS", "eu-west-1"),
    ("FR", _EU, "A13V1IB3VIYZZH", "eu-west-1"),
    ("IN", _EU, "A21TJRUUN4KGV", "eu-west-1"),
    ("IT", _EU, "APJ6JRA9NG5V4", "eu-west-1"),
    ("NL", _EU, "A1805IZSGTT6HS", "eu-west-1"),
    ("SA", _EU, "A17E79C6D8DWNP", "eu-west-1"),
    ("SE", _EU, "A2NODRKZP88ZB9", "eu-west-1"),
    ("TR", _EU, "A33AVAJ2PDY3EV", "eu-west-1"),
    ("UK", _EU, "A1F83G8C2ARO7P", "eu-west-1"),
    ("ZA", _EU, "AE08WJ6YKNBMC", "eu-west-1"),
    ("AU", _FE, "A39IBJ37TRP1C6", "us-west-2"),
    ("JP", _FE, "A1VC38T7YXB528", "us-west-2"),
    ("SG", _FE, "A19VAU5U5O7RUS", "us-west-2"),
    ("US", _NA, "ATVPDKIKX0DER", "us-east-1"),
    ("BR", _NA, "A2Q3Y263D00KWC", "us-east-1"),
    ("CA", _NA, "A2EUQ1WTGCTBG2", "us-east-1"),
    ("MX", _NA, "A1AM78C64UM0Y8", "us-east-1"),
]
# -----------------------------------------------------------------------------


def marketplaces(spark: SparkSession) -> DataFrame:
    """The marketplace dimension; fixed size, so always broadcast."""
    df = spark.createDataFrame(MARKETPLACES, "marketplace_name string, endpoint string, marketplace_id string, "
                                             "region string")
    return F.broadcast(df)


def tenant_lookup(facts: DataFrame, tenants: DataFrame, company_col: str = "company",
                  out: str = "tenant_id") -> DataFrame:
    """Company name → tenant id (the inverse direction is the same join; broadcast
    only where the estimate proves the tenant table small)."""
    t = tenants.select(F.col("company").alias("__company"), F.col("tenant_id").alias(out))
    return facts.join(broadcast_if_small(t), F.col(company_col) == F.col("__company"), "left").drop("__company")


def table_columns(spark: SparkSession, table: str) -> list[str]:
    """Columns of a catalog table (``information_schema.columns``)."""
    return [c.name for c in spark.catalog.listColumns(table)]


def schema_columns(spark: SparkSession, database: str, exclude_like: str = "_console") -> DataFrame:
    """Distinct column names over the tables of a database whose name does not
    contain ``exclude_like`` (metadata only; the session's temporary views, which every
    listing shows, are left out)."""
    rows = [(t.name, c.name, c.dataType) for t in spark.catalog.listTables(database)
            if not t.isTemporary and exclude_like not in t.name for c in spark.catalog.listColumns(t.name, database)]
    return spark.createDataFrame(rows, "table_name string, column_name string, data_type string")


def register_view(df: DataFrame, name: str) -> DataFrame:
    """A named intermediate result for later SQL (``CREATE TEMP VIEW``)."""
    df.createOrReplaceTempView(name)
    return df
