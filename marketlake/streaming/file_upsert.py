"""Structured Streaming form of the incremental load.

New report files landing in a folder are read as a file stream; every
micro-batch is upserted into a keyed table with ``foreachBatch``.  The stream's
checkpoint belongs to the table (``<table>/_stream``, unless the caller names
another shared folder), so a restarted job (or one that lost executors) resumes
where it stopped: files already committed are not read again, and re-running a
batch is idempotent because the upsert is.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from marketlake.sinks.keyed import KeyedTable


def stream_upsert(spark: SparkSession, folder: str, glob: str, schema: T.StructType, table_path: str,
                  keys: Sequence[str], partition_cols: Sequence[str] = (), fmt: str = "parquet",
                  checkpoint: str | None = None, order_by=None, max_files_per_trigger: int | None = None):
    """Run the stream until every file present now is processed (``availableNow``)."""
    table = KeyedTable(spark, table_path, keys, partition_cols, audit=False)
    reader = spark.readStream.schema(schema).option("pathGlobFilter", glob).option("recursiveFileLookup", True)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.format(fmt).load(folder)

    def upsert_batch(batch: DataFrame, epoch_id: int) -> None:
        table.upsert(batch, order_by=order_by)

    q = (stream.writeStream.foreachBatch(upsert_batch)
         .option("checkpointLocation", checkpoint or f"{table_path.rstrip('/')}/_stream")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return q
