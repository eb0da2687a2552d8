"""Keyed tables on Parquet: upsert, insert-ignore, audit columns.

A table is partitioned by columns of its key, or else by a hidden **key bucket**,
``pmod(xxhash64(keys), buckets)``, which every write derives from the key.  So a batch
names the partitions it can meet, however the table is laid out, and there is no
MERGE-capable catalog in a plain Spark session to do better.  A merge is:

1. the batch is cleaned, checked and written once; everything below reads that copy;
2. the distinct partition values the batch touches (the one small ``collect`` in
   operator code: one row per touched partition, e.g. per day or bucket);
3. ``kept = current ⋉̸ batch`` on the key (left anti join), a scan of those partitions only;
4. ``new = batch`` with ``created_at`` carried over from the stored row;
5. ``kept ∪ new`` is written beside the table, whole, and then replaces the touched
   partitions by Spark's dynamic partition overwrite.

A write that dies before step 5 is complete leaves the old table.  One that dies while
partitions are being replaced is done again from the complete copy by the next ``read``
or write; doing it twice does no harm.

Inserts that ignore conflicts only append what is new, after the same pruned anti join.
The stored schema and the number of buckets are kept with the table, so partition values
come back in their own type (``007`` stays text).  Partition columns must be part of the
key, so a row never moves partitions.  Single writer per table is assumed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketlake.functions._util import ts_lit

from marketlake.operators.constraints import VIOLATED, ForeignKey, checked
from marketlake.operators.dedupe import assert_unique, dedupe
from marketlake.operators.names import normalise_names
from marketlake.operators.shape import percent_text_columns, text_to_bool
from marketlake.session import scratch_path
from marketlake.sinks._files import Folder
from marketlake.sinks.tables import replace_from_stage, staged_path

AUDIT = ("created_at", "updated_at")
BUCKET = "__bucket"
BUCKETS = 32        # of a table without partition columns, unless the caller says otherwise


def merge_frames(current: DataFrame, batch: DataFrame, keys: Sequence[str], missing: str = "null",
                 as_of=None, audit: bool = False) -> DataFrame:
    """K01 as a pure DataFrame function: ``INSERT … ON CONFLICT (keys) DO UPDATE``.

    Rows of ``batch`` replace stored rows with the same key (a NULL in the batch
    overwrites, as ``SET col = EXCLUDED.col`` does); other stored rows are kept.
    ``missing='null'``: target columns absent from the batch become NULL (the
    source's behaviour); ``missing='keep'``: they keep the stored value.
    With ``audit``, ``created_at`` survives from the stored row and
    ``updated_at = as_of``.
    """
    keys = list(keys)
    target = [c for c in current.columns if not (audit and c in AUDIT)]
    kept = current.join(batch.select(*keys), keys, "left_anti")
    absent = [c for c in target if c not in batch.columns]
    carry = (absent if missing == "keep" else []) + (["created_at"] if audit and "created_at" in current.columns else [])
    new = batch
    if carry:
        old = current.select(*keys, *[F.col(c).alias(f"__old_{c}") for c in carry])
        new = new.join(old, keys, "left")
    cols = []
    for c in target:
        if c in batch.columns:
            cols.append(F.col(c).cast(current.schema[c].dataType).alias(c))
        elif missing == "keep":
            cols.append(F.col(f"__old_{c}").alias(c))
        else:
            cols.append(F.lit(None).cast(current.schema[c].dataType).alias(c))
    if audit:
        stamp = ts_lit(as_of) if as_of is not None else F.current_timestamp()
        if "created_at" in current.columns:
            cols.append(F.coalesce(F.col("__old_created_at"), stamp).alias("created_at"))
        if "updated_at" in current.columns:
            cols.append(stamp.alias("updated_at"))
    return kept.unionByName(new.select(*cols))


def insert_ignore(current: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``ON CONFLICT DO NOTHING``: only batch rows with new keys are added."""
    fresh = batch.join(current.select(*keys), list(keys), "left_anti")
    return current.unionByName(fresh.select(*current.columns))


def clean_batch(batch: DataFrame, schema: T.StructType | None = None) -> DataFrame:
    """K01 steps 2-5: names normalised; empty text → NULL; with the stored schema, text bound for
    numbers loses ``%`` (and is then divided by 100, per column), text becomes boolean, and every
    column gets its stored type.  Text that does not cast raises."""
    df = normalise_names(batch)
    text = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    df = df.withColumns({c: F.nullif(F.col(f"`{c}`"), F.lit("")) for c in text})
    stored = {f.name: f.dataType for f in schema.fields} if schema else {}
    numeric = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)
    df = percent_text_columns(df, [c for c in text if isinstance(stored.get(c), numeric)], strict=True)
    df = df.withColumns({c: text_to_bool(c) for c in text if isinstance(stored.get(c), T.BooleanType)})
    return df.withColumns({c: F.col(f"`{c}`").cast(stored[c]) for c in df.columns if c in stored})


class KeyedTable:
    """A Parquet table with a primary key, partitioned by columns of the key or by key buckets.

    ``buckets`` counts when the table is created: a bucket is what an upsert rewrites at
    least, so it should be a few hundred megabytes at the size the table will have.
    Upserts and inserts store only rows that keep all ``foreign_keys`` (J16); the others
    are among the rejects, with the names of the constraints.
    """

    SCHEMA = "_schema.json"

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], partition_cols: Sequence[str] = (),
                 audit: bool = True, buckets: int = BUCKETS, foreign_keys: Sequence[ForeignKey] = ()):
        self.spark, self.path = spark, path.rstrip("/")
        self.keys, self.partition_cols, self.audit = list(keys), list(partition_cols), audit
        if not set(self.partition_cols) <= set(self.keys):
            raise ValueError("partition columns must be part of the key")
        self.foreign_keys = list(foreign_keys)
        self._folder = Folder(spark, self.path)
        self._new_buckets = 0 if self.partition_cols else max(1, buckets)

    # -- reading -----------------------------------------------------------
    def exists(self) -> bool:
        return self._folder.exists(self.SCHEMA)

    def schema(self) -> T.StructType:
        return T.StructType.fromJson(self._folder.read_json(self.SCHEMA)["schema"])

    def read(self) -> DataFrame:
        """The table in its stored types; completes a replacement that was cut short."""
        return self._stored().drop(BUCKET)

    # -- layout ------------------------------------------------------------
    def buckets(self) -> int:
        return self._folder.read_json(self.SCHEMA)["buckets"] if self.exists() else self._new_buckets

    def _parts(self) -> list[str]:
        return self.partition_cols or [BUCKET]

    def _placed(self, rows: DataFrame) -> DataFrame:
        """Rows with their bucket, where the table has buckets."""
        if self.partition_cols:
            return rows
        return rows.withColumn(BUCKET, F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets())).cast("int"))

    def _full_schema(self) -> T.StructType:
        hidden = [] if self.partition_cols else [T.StructField(BUCKET, T.IntegerType())]
        return T.StructType([*self.schema().fields, *hidden])

    def _stored(self) -> DataFrame:
        self._finish()
        return self.spark.read.schema(self._full_schema()).parquet(self.path)

    # -- writing -----------------------------------------------------------
    def _finish(self) -> None:
        if self.exists():
            replace_from_stage(self.spark, self.path, self._full_schema(), self._parts())

    def _write(self, rows: DataFrame, path: str, mode: str) -> None:
        """Rows by partition; large partitions are split over tasks, small ones are one file."""
        parts = self._parts()
        (self._placed(rows).hint("rebalance", *parts).write.mode(mode).option("partitionOverwriteMode", "static")
         .partitionBy(*parts).parquet(path))

    def _replace(self, rows: DataFrame) -> None:
        """Put ``rows`` in the place of the partitions that they are in."""
        self._write(rows.select(*self.schema().names), staged_path(self.path), "overwrite")
        self._finish()

    def _create(self, rows: DataFrame) -> None:
        # the table is there once its schema is: what a failed attempt left goes (not a stream's checkpoint)
        for name in self._folder.folders() if self._folder.exists() else []:
            self._folder.delete(name)
        self._write(rows, self.path, "append")
        self._folder.write_json(self.SCHEMA, {"schema": rows.schema.jsonValue(), "buckets": self._new_buckets})

    def _written_batch(self, batch: DataFrame, order_by) -> tuple[DataFrame, DataFrame]:
        """(rows, rejected rows: a NULL key, a foreign key without parent): cleaned, distinct, one per key, from
        a written copy in the shared scratch folder."""
        stored = self.schema() if self.exists() else None
        path = scratch_path(self.spark, "keyed-batch")
        cleaned = clean_batch(batch, stored).distinct()
        if self.foreign_keys:
            cleaned = checked(cleaned, self.foreign_keys)
        cleaned.write.parquet(path)
        copy = self.spark.read.parquet(path)
        no_key = F.lit(False)
        for k in self.keys:
            no_key = no_key | F.col(k).isNull()
        if self.foreign_keys:
            no_key = no_key | (F.size(VIOLATED) > 0)
        good, bad = copy.where(~no_key).drop(VIOLATED), copy.where(no_key)
        if order_by is not None:
            good = dedupe(good, self.keys, order_by, keep="first")
        else:
            assert_unique(good, self.keys)
        return good, bad

    def _where_in(self, rows: DataFrame, found: DataFrame) -> DataFrame:
        """Rows of the partitions that ``found`` has rows in: a filter on partition columns, so only these are
        listed and read."""
        parts = self._parts()
        values = [tuple(r) for r in found.select(*parts).distinct().collect()]
        if len(parts) == 1:
            return rows.where(F.col(parts[0]).isin([v[0] for v in values]) if values else F.lit(False))
        hit = F.lit(False)
        for v in values:
            same = F.lit(True)
            for k, x in zip(parts, v, strict=True):
                same = same & (F.col(k) == F.lit(x))
            hit = hit | same
        return rows.where(hit)

    def _touched(self, batch: DataFrame) -> DataFrame:
        """Stored rows of the partitions that the batch touches."""
        return self._where_in(self._stored(), self._placed(batch)).drop(BUCKET)

    def _stamp(self, df: DataFrame, as_of) -> DataFrame:
        if not self.audit:
            return df
        stamp = ts_lit(as_of) if as_of is not None else F.current_timestamp()
        return df.withColumns({"created_at": stamp, "updated_at": stamp})

    def upsert(self, batch: DataFrame, as_of=None, missing: str = "null", order_by=None) -> DataFrame:
        """K01 (+K10).  Returns the rejected rows (NULL key, or a violated foreign key) as a DataFrame."""
        self._finish()
        good, bad = self._written_batch(batch, order_by)
        if not self.exists():
            self._create(self._stamp(good, as_of))
        else:
            self._replace(merge_frames(self._touched(good), good, self.keys, missing=missing, as_of=as_of,
                                       audit=self.audit))
        return bad

    def insert_ignore(self, batch: DataFrame, as_of=None) -> DataFrame:
        """K03; K04 is ``insert_ignore(dedupe(batch, keys, order))``.  Stored files are not rewritten."""
        self._finish()
        if not self.exists():
            return self.upsert(batch, as_of, order_by=self.keys)
        good, bad = self._written_batch(batch, self.keys)
        fresh = good.join(self._touched(good).select(*self.keys), self.keys, "left_anti")
        self._add(self._stamp(fresh, as_of))
        return bad

    def _add(self, rows: DataFrame) -> None:
        """Append rows; stored columns that they lack are NULL."""
        stored = self.schema()
        cols = [F.col(f.name) if f.name in rows.columns else F.lit(None).cast(f.dataType).alias(f.name)
                for f in stored.fields]
        self._write(rows.select(*cols), self.path, "append")

    def append(self, batch: DataFrame) -> None:
        """Plain insert when the table has no key conflicts to resolve."""
        self._finish()
        rows = clean_batch(batch, self.schema() if self.exists() else None)
        if self.exists():
            self._write(rows.select(*self.schema().names), self.path, "append")
        else:
            self._create(rows)

    def fix_values(self, col: str, old, new, where=None) -> None:
        """K14 on the stored table: only partitions that hold a row to change are rewritten."""
        current = self._stored()
        hit = F.col(col) == F.lit(old)
        if where is not None:
            hit = hit & where
        rows = self._where_in(current, current.where(hit))
        if not rows.isEmpty():
            self._replace(fix_values(rows.drop(BUCKET), col, old, new, where))


def fix_values(df: DataFrame, col: str, old, new, where=None) -> DataFrame:
    """``UPDATE t SET col = new WHERE col = old [AND where]`` as a projection."""
    cond = F.col(col) == F.lit(old)
    if where is not None:
        cond = cond & where
    return df.withColumn(col, F.when(cond, F.lit(new)).otherwise(F.col(col)))


def insert_distinct_on(current: DataFrame, batch: DataFrame, keys: Sequence[str], order=None) -> DataFrame:
    """``INSERT … SELECT DISTINCT ON (keys)`` without conflicts: the batch is
    reduced to one row per key (first under ``order``), then inserted ignoring
    keys already stored."""
    return insert_ignore(current, dedupe(batch, keys, order or list(keys), keep="first"), keys)
