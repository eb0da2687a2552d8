"""Incremental loading.

The reference has no streams; it re-pulls recent windows on a schedule and
keeps only rows past a high-water mark.  The same operators run here as batch
DataFrame plans; ``marketlake.streaming`` wires them to a file stream.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlake.operators.joins import broadcast_if_small

DEFAULT_WATERMARK = "2020-01-01 00:00:00"


def watermarks(current: DataFrame, by: Sequence[str], ts: str, name: str = "watermark") -> DataFrame:
    """High-water mark per key group (one row per group, partial aggregate)."""
    return current.groupBy(*by).agg(F.max(ts).alias(name))


def after_watermark(batch: DataFrame, current: DataFrame, by: Sequence[str], ts: str,
                    default: str = DEFAULT_WATERMARK) -> DataFrame:
    """Rows of ``batch`` newer than the stored high-water mark of *their own*
    group (the source reused the first group's mark for all; fixed here).
    Groups with no stored rows use ``default``.  The mark table has one row per
    group; it is broadcast only when its estimate is small."""
    wm = broadcast_if_small(watermarks(current, by, ts, "__wm"))
    j = batch.join(wm, list(by), "left")
    dflt = F.lit(default).cast(batch.schema[ts].dataType)
    return j.where(F.col(ts) > F.coalesce(F.col("__wm"), dflt)).drop("__wm")


def newer_than_max(batch: DataFrame, current: DataFrame, ts: str, current_ts: str | None = None) -> DataFrame:
    """Rows newer than the table's global max (a scalar subquery)."""
    mx = current.select(F.max(current_ts or ts)).scalar()
    return batch.where(mx.isNull() | (F.col(ts) > mx))


def read_newer_files(spark: SparkSession, fmt: str, path: str, modified_after: str, schema=None,
                     **options) -> DataFrame:
    """Read only files modified after a timestamp (``modifiedAfter``), e.g.
    ``MAX(updated_at)`` of the target table.  Give the schema: when no file is
    newer there is nothing to infer it from."""
    r = spark.read.format(fmt).option("modifiedAfter", modified_after)
    if schema is not None:
        r = r.schema(schema)
    for k, v in options.items():
        r = r.option(k, v)
    return r.load(path)


LEDGER = "path string, length long, modified timestamp"


def unloaded_files(spark: SparkSession, folder: str, glob: str, ledger: str) -> DataFrame:
    """G03 + S16: files below ``folder`` that the ledger does not have in this size and of this time: new and
    changed ones, also those that arrive late with an old time, which a high-water mark would pass by."""
    from marketlake.sinks.tables import _exists
    from marketlake.sources.files import list_files
    found = list_files(spark, folder, glob).select("path", "length", F.col("modificationTime").alias("modified"))
    if not _exists(spark, ledger):
        return found
    return found.join(spark.read.schema(LEDGER).parquet(ledger), ["path", "length", "modified"], "left_anti")


def load_unloaded(spark: SparkSession, folder: str, glob: str, ledger: str, read, write) -> list[str]:
    """Load every file that the ledger lacks: ``write(read(paths))``, then the files are entered.

    A load that dies before the entry is repeated by the next call, so ``write`` should be an upsert (or
    replace what it wrote).  Returns the loaded files; nothing is read when there are none."""
    from marketlake.sources.files import escaped
    new = [tuple(r) for r in unloaded_files(spark, folder, glob, ledger).collect()]
    if new:
        write(read([escaped(path) for path, _, _ in new]))
        spark.createDataFrame(new, LEDGER).coalesce(1).write.mode("append").parquet(ledger)
    return sorted(path for path, _, _ in new)
