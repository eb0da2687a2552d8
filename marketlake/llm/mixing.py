"""Mixing sources to target weights (DataFrame operators only).

**Targets: capped water-filling.**  Sources share the words of the whole input by
weight; no source gets more than ``max_epochs`` times its size, and what a full
source cannot take is shared again among the others by weight until none is
above.  The fixed point of that resharing has a closed form: with the sources
ordered by cap / weight, the first ones are full and the others lie on a common
level (words per unit of weight).  The level is read off running sums, so there
is no loop; the sums run over one row per source.

**Sampling.**  A source's target is so many whole repetitions of each of its
documents plus a fraction.  The fraction takes documents in the order of a seeded
hash until its words are reached; the document on the border is taken if more
than half of it fits.  The running sum is made in two levels (per source and
hash bucket, then inside a bucket), so no task holds a whole source.  The words
taken from a source differ from its target by at most half a document; reruns
agree, because the hash depends on seed and id only.

Documents have a size in words (``[^\\x20\\x09-\\x0D]+``), null text has size 0.
Null sources form a source of their own, last in order.  Rows without words are
never taken by the fraction.  Rows that repeat an id are ordered by size; equal
rows are interchangeable.  An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marketlake.llm._util import ROW, hash_order, materialise, pick

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
MAX_EPOCHS = 3
SEED = 17
BUCKET_DIGITS = 3   # leading hex digits of the hash: 4096 buckets per source


def targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, max_epochs: float = MAX_EPOCHS) -> DataFrame:
    """Water level and targets.  ``sizes``: source, source_size (one row per source).

    Returns source, source_size, target (double).  ``weights`` repeat along the
    sources in code-point order, null last.
    """
    n = len(weights)
    pos = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    w = F.element_at(F.array(*[F.lit(x) for x in weights]), (F.pmod(pos, F.lit(n)) + 1).cast("int"))
    s = sizes.select("source", "source_size", w.alias("weight"), (F.col("source_size") * max_epochs).alias("cap"))
    s = s.withColumn("fill", F.col("cap") / F.col("weight"))
    order = Window.orderBy("fill", F.col("source").asc_nulls_last())
    before, every = order.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    full_cap = F.coalesce(F.sum("cap").over(before), F.lit(0))
    full_weight = F.coalesce(F.sum("weight").over(before), F.lit(0))
    s = s.withColumn("level", (F.sum("source_size").over(every) - full_cap)
                     / (F.sum("weight").over(every) - full_weight))
    # the sources before the first one that can hold the level are full
    s = s.withColumn("rank", F.row_number().over(order))
    level = F.min(F.when(F.col("level") <= F.col("fill"), F.struct("rank", "level"))).over(every)["level"]
    return (s.withColumn("water", F.coalesce(level, F.lit(0.0)))
            .select("source", "source_size",
                    F.least(F.col("cap").cast("double"), F.col("water") * F.col("weight")).alias("target")))


def mix(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights: Sequence[float] = WEIGHTS, max_epochs: float = MAX_EPOCHS, seed: int = SEED,
        carry: bool = False) -> DataFrame:
    """Every row with doc_id, source, size, source_size, target, copies and taken (words, repeats counted).

    ``copies`` says how often the mix repeats the row (0: left out).
    """
    src = pick(df, carry=carry, doc_id=id_col, text=text_col, source=source_col)
    h = hash_order(F.col("doc_id"), seed)
    rows = src.select("doc_id", "source", F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0))
                      .cast("long").alias("size"), h.alias("h"), *([ROW] if carry else []))
    key = F.coalesce(F.concat(F.lit("="), "source"), F.lit("null")).alias("key")
    rows = rows.select("*", key, F.substring("h", 1, BUCKET_DIGITS).alias("bucket"))
    # sizes are counted once; the sums below read a narrow table
    narrow = materialise(rows.select("doc_id", "source", "key", "bucket", "h", "size"), "mixing-sizes")
    buckets = narrow.groupBy("source", "key", "bucket").agg(F.sum("size").alias("words"))
    per_source = targets(buckets.groupBy("source").agg(F.sum("words").alias("source_size")), weights, max_epochs)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    per_source = per_source.select(key, "source_size", "target", whole.alias("whole"))
    ahead = Window.partitionBy("key").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    plan = (buckets.select("key", "bucket", F.coalesce(F.sum("words").over(ahead), F.lit(0)).alias("ahead"))
            .join(per_source, "key")
            .withColumn("part", F.col("target") - F.col("whole") * F.col("source_size")))
    inside = Window.partitionBy("key", "bucket").orderBy("h", "doc_id", "size")
    before = F.coalesce(F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    extra = (F.col("size") > 0) & (F.col("ahead") + before + F.col("size") / 2 < F.col("part"))
    out = (rows if carry else narrow).join(plan, ["key", "bucket"]).withColumn(
        "copies", (F.col("whole") + F.when(extra, 1).otherwise(0)).cast("long"))
    return out.select("doc_id", "source", "size", "source_size", "target", "copies",
                      (F.col("size") * F.col("copies")).alias("taken"), *([ROW] if carry else []))
