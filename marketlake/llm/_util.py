"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlake.session import checkpoint_dir, scratch_path

# Column that carries a whole input row through an operator (see ``pick``).
ROW = "row"


def pick(df: DataFrame, carry: bool = False, **columns: str) -> DataFrame:
    """``pick(df, doc_id="id")``: the named columns only, under the operator's own names.

    Columns are taken by position of their exact name, so further columns of any
    name (also ones that differ only in case, or that are named like a result)
    neither clash nor get in the way.  With ``carry`` the whole input row comes
    along as the struct ``row``; ``restore`` turns it back into columns.
    """
    names = df.columns
    flat = df.toDF(*[f"_c{i}" for i in range(len(names))])
    out = [F.col(f"_c{names.index(src)}").alias(dst) for dst, src in columns.items()]
    if carry:
        out.append(F.struct(*[F.col(f"_c{i}") for i in range(len(names))]).alias(ROW))
    return flat.select(*out)


def restore(df: DataFrame, like: DataFrame) -> DataFrame:
    """The input columns of ``like`` from the carried ``row`` struct."""
    return (df.select(*[F.col(f"{ROW}._c{i}").alias(f"_c{i}") for i in range(len(like.columns))])
            .toDF(*like.columns))


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder of ``spark.checkpoint.dir`` and read it back.

    Cuts the lineage: what follows reads files that every executor sees, so a
    lost executor costs its running tasks only, and an expensive input that is
    used several times is computed once.
    """
    spark = df.sparkSession
    checkpoint_dir(spark)
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


ARROW_BYTES = ("spark.sql.execution.arrow.maxBytesPerBatch", "67108864b", "8m")


def bound_batches(spark: SparkSession) -> None:
    """Smaller Arrow batches for the rows that go to Python workers, where the session has Spark's default:
    a batch is held several times over (in the JVM, in the worker, and as what comes back)."""
    key, default, ours = ARROW_BYTES
    if spark.conf.get(key, None) in (default, None, ""):
        spark.conf.set(key, ours)


def hash_order(col: Column, seed: int) -> Column:
    """Seeded pseudo-random order key (32 hex digits) of an id; null has a place of its own."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), F.coalesce(col.cast("string"), F.lit("null"))))


JOIN_SALTS = 16


def smallest_hashes(n: int, count: int) -> str:
    """A bound on ``hash_order`` that about four times ``count`` of ``n`` ids fall below (all ids if
    there are fewer), so that the smallest ``count`` can be picked from few rows of each task."""
    share = min(1.0, 4 * count / n) if n else 1.0
    return "f" * 32 if share == 1.0 else format(int(share * 0xFFFFFFFF), "08x") + "f" * 24


def salted_lookup(rows: DataFrame, lookup: DataFrame, key: list[str], spread: Column, how: str = "inner",
                  salts: int = JOIN_SALTS) -> DataFrame:
    """Join ``rows`` to ``lookup`` (one short row per key) when one key may hold a third of the rows.

    The rows of a key are dealt to ``salts`` pieces by the hash of ``spread``, and the lookup rows are
    repeated once per piece.  The join is a sort-merge join: repeated rows compress so well that the
    measured shuffle size would pass for small and invite a broadcast many times the threshold.
    """
    dealt = rows.withColumn("_salt", F.pmod(F.xxhash64(spread), F.lit(salts)).cast("int"))
    repeated = lookup.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return dealt.join(repeated.hint("merge"), [*key, "_salt"], how).drop("_salt")


def by_size(texts: list[str | None], limit: int) -> Iterator[list[str | None]]:
    """Runs of texts of about ``limit`` characters (a longer text is a run of its own), so what a
    worker holds at once is bounded by the longest text, not by the number of long ones."""
    run: list[str | None] = []
    held = 0
    for text in texts:
        size = len(text) if text else 0
        if run and held + size > limit:
            yield run
            run, held = [], 0
        run.append(text)
        held += size
    if run:
        yield run


def runs_of(texts: pa.Array, limit: int, rows: int = 1000) -> Iterator[list[str | None]]:
    """``by_size`` over an Arrow array, turned into Python values a slice at a time."""
    for at in range(0, len(texts), rows):
        yield from by_size(texts.slice(at, rows).to_pylist(), limit)


def release_memory() -> None:
    """Give a worker's freed memory back to the system at the end of a task.

    Spark keeps idle Python workers for reuse; what their allocators hold back would otherwise
    add to the executor's memory while the JVM runs the next stage.
    """
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):   # another C library: it has its own ways
        pass
