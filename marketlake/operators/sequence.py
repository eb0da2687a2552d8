"""Order-dependent operators that stay skew-safe.

``row_number() OVER (PARTITION BY g ORDER BY o)`` sends every row of a group to
one task; with one group holding a third of the data that task is the job.
Here the rows are cut into *segments* of the order ``(g, o)``, and the windows run
per (group, segment), so a hot group spreads over many tasks.  One short row per
(group, segment) brings in what the segments before it add up to; it meets the
rows in the same window, so the rows shuffle once.

The number of a row's segment is a pure function of the row: the bounds come from
a sample that is picked by hash, as a scalar subquery, and are found by binary
search.  So building a query runs no job, nothing is written, and a recomputed
task gives the same numbers.  The input is read three more times, but only its
order columns (a count, the sample, the segments' sums); write an input that is
costly to compute to a table first.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketlake.operators.dedupe import sort_exprs, total_spec
from marketlake.operators.joins import estimated_bytes


UNKNOWN_BYTES = 1 << 60              # Spark's estimate where it knows nothing is of this order
TARGET_BYTES = 128 * 1024 * 1024     # of the optimizer's estimate, per segment
SAMPLE_ROWS = 20                     # expected sample per segment
HASH_RANGE = 1 << 40


def segment_count(df: DataFrame) -> int:
    """Segments for the input's size: the session's shuffle partitions, or more where the
    estimated bytes per segment would pass ``TARGET_BYTES``."""
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    size = estimated_bytes(df)
    if size is None or size >= UNKNOWN_BYTES:
        return least
    return max(least, -(-size // TARGET_BYTES))


def _turned(c: Column, kind: str) -> list[Column] | None:
    """Fields whose order is the reverse of the values' order; None for types that have no such form."""
    if kind in ("byte", "short", "integer", "long"):
        return [F.bitwise_not(c)]
    if kind in ("float", "double"):
        return [~F.isnan(c), -c]
    if kind in ("string", "binary"):    # complements of the bytes, with an end above every digit
        return [F.concat(F.translate(F.hex(c), "0123456789ABCDEF", "FEDCBA9876543210"), F.lit("~"))]
    turn = {"decimal": lambda: -c, "date": lambda: -F.unix_date(c), "timestamp": lambda: F.bitwise_not(F.unix_micros(c)),
            "boolean": lambda: ~c}.get(kind)
    return [turn()] if turn else None


def _sort_key(df: DataFrame, group: Sequence[str], spec) -> tuple[Column, bool]:
    """A struct whose own order is the order of ``spec`` within a group, and whether it falls.  NULL
    placement is a flag field before the value; where the direction turns, the values are turned, too.
    The struct ends before a turned column of another type: rows equal up to there share a segment."""
    falls = bool(spec) and spec[0][1]
    columns = [F.col(c) if isinstance(c, str) else c for c, _, _ in spec]
    kinds = [f.dataType.typeName() for f in df.select(*columns).schema.fields]
    fields = [F.col(g) for g in group]
    for c, kind, (_, desc, nulls_first) in zip(columns, kinds, spec, strict=True):
        values = [c] if desc == falls else _turned(c, kind)
        if values is None:
            break
        fields += [c.isNull() if nulls_first == falls else c.isNotNull(), *values]
    return F.struct(*[f.alias(f"k{i}") for i, f in enumerate(fields)]), falls


def _bounds(keyed: DataFrame, n: int) -> Column:
    """At most ``n - 1`` ascending bounds as a scalar subquery.  The sample takes every distinct key whose
    hash is below a share of the row count, so it is the same in every run and has about
    ``SAMPLE_ROWS * n`` keys at most, however often a key repeats."""
    rows = keyed.select(F.count(F.lit(1))).scalar()
    share = F.lit(float(SAMPLE_ROWS * n)) / F.greatest(rows, F.lit(1))
    sample = keyed.select("__k").where(F.pmod(F.xxhash64("__k"), F.lit(HASH_RANGE)) < share * F.lit(HASH_RANGE))
    ordered = sample.agg(F.sort_array(F.collect_set("__k")).alias("__s"))
    at = F.transform(F.sequence(F.lit(1), F.lit(n - 1)), lambda j: F.floor(j * F.size("__s") / F.lit(n)).cast("int"))
    return ordered.select(F.filter(F.transform(at, lambda j: F.get("__s", j)), lambda b: b.isNotNull())).scalar()


def _segments(df: DataFrame, group: Sequence[str], spec, partitions: int | None = None) -> DataFrame:
    """``df`` with ``__seg``, which rises along the order of ``spec`` within each group."""
    n = partitions or segment_count(df)
    if n < 2:
        return df.withColumn("__seg", F.lit(0))
    key, falls = _sort_key(df, group, spec)
    keyed = df.withColumn("__k", key)
    keyed = keyed.withColumn("__b", _bounds(keyed, n))
    steps = [1 << i for i in reversed(range((n - 1).bit_length()))]
    found = F.aggregate(F.array(*[F.lit(s) for s in steps]), F.lit(0), lambda low, step: F.when(
        F.get("__b", low + step - 1) <= F.col("__k"), low + step).otherwise(low))
    return keyed.withColumn("__seg", F.lit(n) - found if falls else found).drop("__k", "__b")


def _with_heads(seg: DataFrame, heads: DataFrame, group: Sequence[str], spec) -> tuple[DataFrame, Window]:
    """Rows and one head row per (group, segment) together, and the window in which the head comes first."""
    both = seg.withColumn("__row", F.lit(1)).unionByName(heads.withColumn("__row", F.lit(0)), allowMissingColumns=True)
    w = Window.partitionBy(*group, "__seg").orderBy("__row", *sort_exprs(spec))
    return both, w.rowsBetween(Window.unboundedPreceding, 0)


def ordinal(df: DataFrame, group: Sequence[str], order, name: str = "rn", ties=None,
            partitions: int | None = None) -> DataFrame:
    """1-based position of each row inside its group under ``order``
    (the value of ``row_number()``), computed without a per-group task."""
    spec = total_spec(df, group, order, ties)
    seg = _segments(df, group, spec, partitions)
    before = Window.partitionBy(*group).orderBy("__seg").rowsBetween(Window.unboundedPreceding, -1)
    heads = (seg.groupBy(*group, "__seg").agg(F.count(F.lit(1)).alias("__n"))
             .select(*group, "__seg", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__off")))
    both, w = _with_heads(seg, heads, group, spec)
    # the head counts as the rows before its segment, every row as one
    out = both.withColumn("__rn", F.sum(F.coalesce("__off", F.lit(1))).over(w)).where("__row = 1")
    return out.drop("__seg", "__row", "__off").withColumnRenamed("__rn", name)


def request_batches(df: DataFrame, group: Sequence[str], order, item: Column, size: int = 20,
                    batch_col: str = "batch_no", items_col: str = "items", partitions: int | None = None) -> DataFrame:
    """W06 + N09: split each group into batches of ``size`` items in ``order`` and
    build one request per batch: an ordered array of ``item`` structs.
    A batch holds at most ``size`` items, so ``collect_list`` is bounded."""
    numbered = ordinal(df, group, order, "__rn", partitions=partitions)
    numbered = numbered.withColumn(batch_col, F.floor((F.col("__rn") - 1) / F.lit(size)).cast("bigint"))
    packed = numbered.groupBy(*group, batch_col).agg(
        F.array_sort(F.collect_list(F.struct(F.col("__rn").alias("pos"), item.alias("item")))).alias("__l"))
    return packed.select(*group, batch_col, F.transform("__l", lambda x: x["item"]).alias(items_col))


def carry_down(df: DataFrame, group: Sequence[str], order, is_master: Column, cols: Sequence[str],
               prefix: str = "master_", partitions: int | None = None) -> DataFrame:
    """Repeat values of each master row on the rows that follow it (within
    ``group`` under ``order``) until the next master row.

    Equals ``last(when(is_master, c), ignorenulls) OVER (PARTITION BY group ORDER BY
    order ROWS UNBOUNDED PRECEDING)``, but a long group is cut into segments: the
    head row of a segment brings the last master's values of the segments before it
    (a window over at most one row per segment and group).
    """
    spec = total_spec(df, group, order, None)
    # a struct is non-NULL even when the master's values are NULL, so NULLs carry too
    seg = _segments(df, group, spec, partitions).withColumn("__v", F.when(is_master, F.struct(*[F.col(c) for c in cols])))
    # the last master's values of each segment; segments without masters get a head, too
    place = Window.partitionBy(*group, "__seg").orderBy(*sort_exprs(spec))
    masters = seg.where(F.col("__v").isNotNull()).withColumn("__p", F.row_number().over(place))
    last = (masters.select(*group, "__seg", "__p", "__v")
            .unionByName(seg.select(*group, "__seg").distinct(), allowMissingColumns=True)
            .groupBy(*group, "__seg").agg(F.max_by("__v", "__p").alias("__l")))
    before = Window.partitionBy(*group).orderBy("__seg").rowsBetween(Window.unboundedPreceding, -1)
    heads = last.select(*group, "__seg", F.last("__l", ignorenulls=True).over(before).alias("__v"))
    both, w = _with_heads(seg, heads, group, spec)
    out = both.withColumn("__v", F.last("__v", ignorenulls=True).over(w)).where("__row = 1")
    out = out.withColumns({f"{prefix}{c}": F.col("__v")[c] for c in cols})
    return out.drop("__seg", "__row", "__v")
