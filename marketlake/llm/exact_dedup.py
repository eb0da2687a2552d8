"""Exact duplicates by content sort (DataFrame operators only).

Texts are equal when identical after every character of ``[\\x20\\x09-\\x0D]`` is
deleted; null counts as empty.

1. ``repartitionByRange`` samples splitters and range-partitions the normalised
   bytes: by their first ``HEAD`` characters, then by a hash of all of them (so a
   splitter stays short and a common opening line is no hot spot), then by a salt
   of the id (so copies of one text may span several partitions, and a text that
   makes up a third of all rows never meets in one task).
2. Within a range the rows are sorted externally and neighbours are compared in
   full.  This is what Spark's sort-based aggregation on (head, hash, salt, bytes)
   does, and the range partitioning already satisfies it, so there is no second
   shuffle of texts.  Each run leaves one row.
3. The runs of one text meet by SHA-256 (one short row per run; summed map-side
   first).  Only texts with several copies are joined back to the rows, again
   salted, so the hot text spreads.

Every input row is kept in the result.  Of equal texts the row with the most code
points in the original text stays, then the smallest id (null ids last).  Rows
of one id whose texts are equal and equally long are not told apart by that order,
so all of them carry ``kept = true`` when theirs is the row that stays;
``deduplicated`` keeps one of them, by a hash of the text.  Empty tables give empty
results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlake.llm._util import ROW, pick

# White space that normalisation deletes: space and U+0009 .. U+000D.
WHITE_SPACE = " \t\n\x0b\x0c\r"
HEAD = 32           # characters of the text in a splitter
RUN_SALTS = 64      # pieces a text's copies are sorted in
JOIN_SALTS = 16     # pieces a text's copies are joined in


def normalised(text: Column) -> Column:
    """The text without white space (null: empty)."""
    out = F.coalesce(text, F.lit(""))
    for ch in WHITE_SPACE:
        out = F.replace(out, F.lit(ch), F.lit(""))
    return out


def digest(normal: Column) -> Column:
    """SHA-256 in hex (never null, which spares the join a filter that would hash every text twice)."""
    return F.coalesce(F.sha2(normal, 256), F.lit(""))


def _salt(salts: int) -> Column:
    return F.pmod(F.xxhash64("doc_id"), F.lit(salts)).cast("int")


def runs(src: DataFrame) -> DataFrame:
    """One row per (text, salt): digest, number of copies, best row.  ``src``: doc_id, text."""
    keyed = src.select(
        normalised(F.col("text")).alias("bytes"), _salt(RUN_SALTS).alias("salt"),
        F.struct((-F.length(F.coalesce("text", F.lit("")))).alias("neg_len"),
                 F.col("doc_id").isNull().alias("no_id"), F.col("doc_id")).alias("best"))
    key = ["head", "hash", "salt"]
    keyed = keyed.select("*", F.substring("bytes", 1, HEAD).alias("head"), F.xxhash64("bytes").alias("hash"))
    return (keyed.repartitionByRange(*key)
            .groupBy(*key, "bytes").agg(F.count(F.lit(1)).alias("copies"), F.min("best").alias("best"))
            .select(digest(F.col("bytes")).alias("text_sha256"), "copies", "best"))


def groups(src: DataFrame) -> DataFrame:
    """One row per text that occurs more than once: text_sha256, group_size, keep_id, keep_len."""
    return (runs(src).groupBy("text_sha256")
            .agg(F.sum("copies").alias("group_size"), F.min("best").alias("best"))
            .filter("group_size > 1")
            .select("text_sha256", "group_size", F.col("best.doc_id").alias("keep_id"),
                    (-F.col("best.neg_len")).alias("keep_len")))


def _grouped(df: DataFrame, id_col: str, text_col: str, carry: bool) -> DataFrame:
    src = pick(df, carry=carry, doc_id=id_col, text=text_col)
    copies = (groups(src.select("doc_id", "text"))
              .select("*", F.explode(F.sequence(F.lit(0), F.lit(JOIN_SALTS - 1))).alias("salt")))
    rows = src.select("doc_id", digest(normalised(F.col("text"))).alias("text_sha256"), _salt(JOIN_SALTS).alias("salt"),
                      F.length(F.coalesce("text", F.lit(""))).alias("len"),
                      *([F.xxhash64("text").alias("tie"), ROW] if carry else []))
    grouped = F.col("group_size").isNotNull()
    keep = F.when(grouped, F.col("keep_id")).otherwise(F.col("doc_id"))
    # a sort-merge join: the repeated rows compress so well that they would pass for small
    return (rows.join(copies.hint("merge"), ["text_sha256", "salt"], "left")
            .select("doc_id", keep.alias("keep_id"),
                    F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
                    (~grouped | F.col("doc_id").eqNullSafe(keep) & (F.col("len") == F.col("keep_len"))).alias("kept"),
                    "text_sha256", "salt", *(["tie", ROW] if carry else [])))


def exact_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     carry: bool = False) -> DataFrame:
    """Every row with keep_id, group_size, kept and text_sha256 (and ``row`` if ``carry``)."""
    return _grouped(df, id_col, text_col, carry).drop("salt", "tie")


def deduplicated(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows that stay, as ``row``; of rows that agree in id, text and length the one whose text has
    the smallest hash.

    Such rows already lie together after the join, so dropping them needs no further shuffle.
    """
    return (_grouped(df, id_col, text_col, carry=True).filter("kept")
            .groupBy("text_sha256", "salt", "doc_id").agg(F.min_by(ROW, "tie").alias(ROW)).select(ROW))
