"""Append / replace loads, load guards, table creation and exports."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketlake.functions._util import ts_lit
from marketlake.operators.dedupe import latest_per_key
from marketlake.operators.joins import estimated_bytes
from marketlake.sinks._files import Folder


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def load(df: DataFrame, path: str, mode: str = "append", partition_by: Sequence[str] = ()) -> None:
    """``if_exists = append | replace`` (replace: the whole table, whatever partitions it has)."""
    mode = {"replace": "overwrite"}.get(mode, mode)
    w = df.write.mode(mode).option("partitionOverwriteMode", "static")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def loaded_on(spark: SparkSession, path: str, stamp_col: str, day: dt.date, date_partition: str | None = None) -> bool:
    """K06 guard: ``MAX(DATE(stamp_col)) = day``.

    With ``date_partition`` (the table is partitioned by load day) the answer is
    whether the load of that day was committed: ``append_once`` puts down a marker
    after its write, so a folder left by a write that failed does not count.  A
    metadata call, no scan, whatever the table's size.  Otherwise one column is
    scanned."""
    if not _exists(spark, path):
        return False
    if date_partition:
        return Folder(spark, path).exists(f"_loaded/{date_partition}={day.isoformat()}")
    mx = spark.read.parquet(path).agg(F.max(F.to_date(stamp_col)).alias("d")).first()["d"]
    return mx == day


def append_once(df: DataFrame, path: str, stamp_col: str, as_of: dt.datetime,
                partition_by: Sequence[str] = (), date_partition: str | None = "load_date") -> bool:
    """Append ``df`` stamped with ``as_of`` unless a load already happened that
    day (UTC).  Returns whether it wrote.  By default the append log is
    partitioned by ``load_date`` so the guard is a folder lookup."""
    spark = df.sparkSession
    if loaded_on(spark, path, stamp_col, as_of.date(), date_partition):
        return False
    out = df.withColumn(stamp_col, ts_lit(as_of))
    parts = list(partition_by)
    if date_partition:
        out = out.withColumn(date_partition, F.lit(as_of.date().isoformat()).cast("date"))
        parts = [date_partition, *parts]
        # what a failed write of this day may have left is replaced, not added to
        w = out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*parts)
        w.parquet(path)
        Folder(spark, path).write_json(f"_loaded/{date_partition}={as_of.date().isoformat()}", {"at": as_of.isoformat()})
    else:
        load(out, path, "append", parts)
    return True


def staged_path(path: str) -> str:
    """Where the rows that are to replace (a part of) the table at ``path`` are written first."""
    return path.rstrip("/") + "__next"


def replace_from_stage(spark: SparkSession, path: str, schema: T.StructType | None = None,
                       partition_by: Sequence[str] = ()) -> bool:
    """Overwrite the table at ``path`` with its complete stage, if there is one; partitioned tables only
    the partitions that the stage has.  The stage goes last, so this can be repeated after a failure."""
    stage = Folder(spark, staged_path(path))
    if not stage.exists("_SUCCESS"):
        return False
    reader = spark.read.schema(schema) if schema is not None else spark.read
    w = reader.parquet(stage.path).write.mode("overwrite")
    if partition_by:
        w = w.option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by)
    w.parquet(path)
    stage.delete("")
    return True


def rewrite_deduped(spark: SparkSession, path: str, keys: Sequence[str], order,
                    partition_by: Sequence[str] = ()) -> None:
    """``CREATE OR REPLACE TABLE AS … row_number() = 1`` on a Parquet path.
    The de-duplicated copy is complete beside the table before it replaces it; a
    replacement that was cut short is done again by the next call."""
    replace_from_stage(spark, path)
    rows = latest_per_key(spark.read.parquet(path), keys, order)
    load(rows, staged_path(path), "overwrite", partition_by)
    w = spark.read.parquet(staged_path(path)).write.mode("overwrite")
    (w.partitionBy(*partition_by) if partition_by else w).option("partitionOverwriteMode", "static").parquet(path)
    Folder(spark, staged_path(path)).delete("")


def create_empty(spark: SparkSession, schema: T.StructType, path: str | None = None,
                 created_at: bool = True, updated_at: bool = True) -> DataFrame:
    """An empty table with ``schema`` (+ audit columns); written when a
    path is given."""
    fields = list(schema.fields)
    if created_at:
        fields.append(T.StructField("created_at", T.TimestampType()))
    if updated_at:
        fields.append(T.StructField("updated_at", T.TimestampType()))
    df = spark.createDataFrame([], T.StructType(fields))
    if path:
        df.write.mode("overwrite").parquet(path)
    return df


def empty_like(df: DataFrame) -> DataFrame:
    """``CREATE TABLE … (LIKE t)`` / ``LIMIT 0``."""
    return df.limit(0)


def with_default(df: DataFrame, col: str, value, dtype: str = "int") -> DataFrame:
    """Add (or back-fill) a column with a default, e.g. ``tenant_id = 1``."""
    if col in df.columns:
        return df.withColumn(col, F.coalesce(F.col(col), F.lit(value).cast(dtype)))
    return df.withColumn(col, F.lit(value).cast(dtype))


def export_mart(df: DataFrame, path: str, fmt: str = "parquet", partition_by: Sequence[str] = ("tenant_id",)) -> None:
    """One output per tenant (folder per tenant_id), Parquet or CSV with header.  An export replaces
    the outputs of the tenants that it holds; those of others stay."""
    parts = [c for c in partition_by if c in df.columns]
    w = (df.hint("rebalance", *parts) if parts else df).write.mode("overwrite").format(fmt)
    if fmt == "csv":
        w = w.option("header", True)
    if parts:
        w = w.option("partitionOverwriteMode", "dynamic").partitionBy(*parts)
    w.save(path)


def export_daily(df: DataFrame, path: str, date_col: str = "date", fmt: str = "csv") -> None:
    """One folder per day; days that already have one are skipped (their rows
    are anti-joined away; the list of days is the folder's listing)."""
    folder = Folder(df.sparkSession, path)
    done = [n.split("=", 1)[1] for n in folder.folders() if n.startswith(f"{date_col}=")] if folder.exists() else []
    if done:
        days = df.sparkSession.createDataFrame([(d,) for d in done], "__day string")
        df = df.join(days, F.col(date_col).cast("string") == F.col("__day"), "left_anti")
    w = df.hint("rebalance", date_col).write.mode("append").format(fmt)     # a file or a few per day
    if fmt == "csv":
        w = w.option("header", True)
    w.partitionBy(date_col).save(path)


SPLIT_BYTES = 16 << 20  # of the estimated text: with less for a task, rows are dealt to all cores before they are parsed
# What a text value may stand for: one bit each, in the order in which a column's type is chosen.
KINDS = ("bigint", "double", "boolean", "date", "timestamp", "object", "array<string>", "array<bigint>", "array")


def _kinds_of(cells: DataFrame) -> DataFrame:
    """(at, bits) of text cells (at, value): one bit for every kind that the value parses as (all bits for
    NULL / blank).

    A cheap pattern test guards every cast: a failed ``try_cast`` / ``try_to_timestamp`` costs an
    exception per value, which made mostly-text columns ~10x slower to scan.  What several kinds look at
    is a column of its own, so every value is parsed once."""
    v, t, nested = F.col("v"), F.col("t"), F.col("nested")
    parsed = cells.select("at", F.trim("value").alias("v"))
    parsed = parsed.select(
        "at", "v", v.rlike(r"^[+-]?0\d").alias("code"),           # a number would lose the zeros
        F.when(v.rlike(r"^\d{4}-\d{1,2}-\d{1,2}([ T].*)?$"), F.try_to_timestamp(v)).alias("t"),
        F.when(v.rlike(r"^[\[{]"), F.schema_of_variant(F.try_parse_json(v))).alias("nested"))
    zoned = v.rlike(r"\d(Z|[+-]\d{2}:?\d{2})$") & v.contains(":")
    empty = nested == "ARRAY<VOID>"
    ok = {"bigint": F.when(v.rlike(r"^[+-]?\d+$") & ~F.col("code"), v.try_cast("bigint")).isNotNull(),
          "double": F.when(v.rlike(r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$") & ~F.col("code"), v.try_cast("double")).isNotNull(),
          "boolean": F.lower(v).isin("true", "false", "0", "1"),
          # an instant that names its zone keeps it, at midnight, too
          "date": F.when(t.isNotNull(), (t == F.date_trunc("day", t)) & ~zoned),
          "timestamp": t.isNotNull(),
          "object": F.startswith(nested, F.lit("OBJECT<")),
          "array<string>": empty | (nested == "ARRAY<STRING>"),
          "array<bigint>": empty | (nested == "ARRAY<BIGINT>"),
          "array": F.startswith(nested, F.lit("ARRAY<"))}
    bits = F.lit(0)
    for i, kind in enumerate(KINDS):
        bits = bits + F.when(ok[kind], F.lit(1 << i)).otherwise(F.lit(0))
    return parsed.select("at", F.when(v.isNull() | (v == ""), F.lit((1 << len(KINDS)) - 1)).otherwise(bits).alias("bits"))


def _spread(df: DataFrame) -> DataFrame:
    """The rows over all cores, where the input has fewer splits: parsing takes far longer than reading."""
    spark = df.sparkSession
    cores = spark.sparkContext.defaultParallelism
    size = estimated_bytes(df)
    return df.repartition(4 * cores) if size is not None and size < 4 * cores * SPLIT_BYTES else df


def _type_of(bits: int | None) -> T.DataType:
    """The type of a column whose values all have these kinds."""
    every = (1 << len(KINDS)) - 1
    found = [k for i, k in enumerate(KINDS) if (every if bits is None else bits) & (1 << i)]
    if not found:
        return T.StringType()
    if "array" in found and found[0] not in ("bigint", "double", "boolean", "date", "timestamp", "object"):
        # lists that are all empty fit either element type, and so say nothing of it
        return T.VariantType() if found[0] == "array" or "array<bigint>" in found[1:] else T.DataType.fromDDL(found[0])
    return T.VariantType() if found[0] == "object" else T.DataType.fromDDL(found[0])


def infer_schema(df: DataFrame) -> T.StructType:
    """Type inference for text columns from the data, in one aggregate job.

    A string column becomes bigint when every non-NULL value casts to an
    integer, double when every value casts to a number, boolean for
    true/false/0/1 spellings, date when every value is a timestamp at midnight
    without a zone, timestamp when every value parses as one; array<string> or
    array<bigint> when every value is a JSON list of these, variant when every value
    is a JSON object, or a list of other things; else it stays string.  Numbers with
    leading zeros are codes and stay text.  (64-bit integers always; the source
    picked 32-bit types by size, E17.)  Other column types are kept.  All rows are
    read: types from a sample could be too narrow for the rest.
    """
    text = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    if not text:
        return df.schema
    # one short expression for the cells of all columns; bit_and per column, merged map-side: a kind
    # survives only if every value has it
    cells = _spread(df.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(text)])).select(
        F.posexplode(F.array(*[f"c{i}" for i in range(len(text))])).alias("at", "value"))
    flags = {r["at"]: r["bits"] for r in _kinds_of(cells).groupBy("at").agg(F.bit_and("bits").alias("bits")).collect()}
    return T.StructType([T.StructField(f.name, _type_of(flags.get(text.index(f.name))), True) if f.name in text else f
                         for f in df.schema.fields])


def with_types(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Text columns in the types that ``infer_schema`` found (blank: NULL); a value that does not fit raises."""
    out = []
    for f in schema.fields:
        c = F.col(f"`{f.name}`")
        if not isinstance(df.schema[f.name].dataType, T.StringType) or isinstance(f.dataType, T.StringType):
            out.append(c)
            continue
        v = F.nullif(F.trim(c), F.lit(""))
        if isinstance(f.dataType, T.VariantType):
            v = F.parse_json(v)
        elif isinstance(f.dataType, T.ArrayType):
            v = F.from_json(v, f.dataType, {"mode": "FAILFAST"})
        elif isinstance(f.dataType, T.DateType):
            v = F.to_date(F.to_timestamp(v))
        elif isinstance(f.dataType, T.TimestampType):
            v = F.to_timestamp(v)
        else:
            v = v.cast(f.dataType)
        out.append(v.alias(f.name))
    return df.select(*out)


def add_column_to_tables(spark: SparkSession, databases: Sequence[str], col: str, dtype: str, value,
                         exclude: Sequence[str] = ()) -> list[str]:
    """``ALTER TABLE … ADD COLUMN col dtype DEFAULT value`` on every table of the schemas that lacks the
    column.  Stored rows read as ``value``: the default is metadata, no file is rewritten.  Returns the
    tables that were changed; tables that have the column are left alone, so it can be repeated."""
    done = []
    for database in databases:
        for t in spark.catalog.listTables(database):
            name = f"{database}.{t.name}"
            if t.isTemporary or t.tableType == "VIEW" or t.name in exclude:
                continue
            if col.lower() in (c.name.lower() for c in spark.catalog.listColumns(name)):
                continue
            quoted = ".".join(f"`{x}`" for x in (database, t.name))
            literal = "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'" if isinstance(value, str) else str(value)
            spark.sql(f"ALTER TABLE {quoted} ADD COLUMNS (`{col}` {dtype} DEFAULT {literal})")
            done.append(name)
    return sorted(done)
