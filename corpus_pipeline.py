"""Corpus pipeline: five stages over ``documents``.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and
returns a DataFrame, which is written as Parquet and reread as the next stage's
``docs``.  All but the last return the columns of ``documents``.

1. toxicity: rows that the classifier rejects go.
2. exact_dedup: of equal texts one row stays; of rows that repeat both id and text, too.
3. minhash_dedup: one document of each group of near copies stays (five words, 0.8).
   Rows that share the id that stays, with different texts, stay together.
4. mixing: every row is repeated as often as the mix takes it, or left out.  Rows without words take
   nothing from a target, so they pass once.
5. sentencepiece: ids and digests of every row that is left; the decoded text comes from the ids.

Rows with null ids or null texts pass: a null text counts as empty.  Empty tables
give empty results.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlake.llm import exact_dedup, minhash_dedup, mixing, queries, sentencepiece_bpe, toxicity
from marketlake.llm._util import bound_batches, materialise, pick, restore


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    bound_batches(spark)
    model = toxicity.train(docs, queries.table(spark, sf_dir, "labels"), where=toxicity.learnable(F.col("doc_id")))
    return restore(toxicity.score(docs, model, carry=True).filter("predicted = 0"), docs)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return restore(exact_dedup.deduplicated(docs), docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    bound_batches(spark)
    return restore(minhash_dedup.near_duplicates(docs, carry=True).filter("kept"), docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    copies = F.when(F.col("size") == 0, F.lit(1)).otherwise(F.col("copies"))
    taken = mixing.mix(docs, carry=True).withColumn("copies", copies).filter("copies > 0")
    return restore(taken.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies")))), docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, ids, n_tokens, ids_sha256, decoded_sha256."""
    bound_batches(spark)
    encoded = sentencepiece_bpe.encode_decode(pick(docs, doc_id="doc_id", text="text"), queries.piece_model_path())
    return sentencepiece_bpe.digests(encoded, with_ids=True)


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_exact_copies),
    ("minhash_dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("sentencepiece", encode),
]

# Learned decisions and MinHash have no SQL form; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = queries.table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
