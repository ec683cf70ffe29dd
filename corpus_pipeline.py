"""A training-data pipeline: documents to token ids in five stages.

Toxic documents go, one document of each near-duplicate group stays, passages
that an earlier document has are cut, sources are mixed to their targets, and
what the mix takes is encoded. Each stage reads all that the one before kept,
and its table is written to the shared folder before the next one starts.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybayes.llm import bpe, mixing, simhash, substring_dedup, toxicity
from tallybayes.llm._util import Stage, fresh, prepare


def _columns(df: DataFrame, docs: DataFrame) -> DataFrame:
    return df.select(*[F.col(f"`{c}`") for c in docs.columns])


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not call toxic; null and empty texts score as the bias alone."""
    prepare(spark)
    model = toxicity.train(docs, _labels(spark, sf_dir))
    (score,) = fresh(docs, "toxic_score")
    scored = docs.withColumn(score, toxicity.score(F.col("text"), model, spark))
    return _columns(scored.filter(F.col(score) < 0.5), docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component (3-word shingles, 2 bits): the one with the smallest id."""
    return simhash.dedup(docs, words=3, radius=2)


def cut_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the words of 50-word windows that an earlier one has.

    A text that loses words is what is left, joined by single spaces, and
    n_chars follows it; a document that loses all stays, with the empty text.
    Other texts stay as they are.
    """
    out, r = substring_dedup.dedup(docs, seed=25)
    cut = F.col(f"{r}.n_removed") > 0
    out = out.withColumn("text", F.when(cut, F.col(f"{r}.kept")).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        chars = F.length("text").cast(dict(docs.dtypes)["n_chars"])
        out = out.withColumn("n_chars", F.when(cut, chars).otherwise(F.col("n_chars")))
    return _columns(out, docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as often as the mix takes them; those that it doesn't take go."""
    return mixing.apply(docs, mixing.mix(docs, mixing.quality(_labels(spark, sf_dir))))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, source, n_tokens, ids, ids_sha256, decoded_sha256) of each row.

    ``ids`` holds little-endian unsigned 32-bit integers; null texts have none.
    """
    prepare(spark)
    vocabulary, pattern = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    coded = docs.select("doc_id", "source", bpe.encode(F.col("text"), vocabulary, pattern).alias("code"))
    text = bpe.decode(F.col("code.ids"), vocabulary, pattern)
    return coded.select(
        "doc_id",
        "source",
        F.col("code.n_tokens").cast("long").alias("n_tokens"),
        F.col("code.ids").alias("ids"),
        F.sha2("code.ids", 256).alias("ids_sha256"),
        F.sha2(text.cast("binary"), 256).alias("decoded_sha256"),
    )


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash near-dedup", drop_near_duplicates),
    ("substring dedup", cut_repeated_passages),
    ("source mixing", mix_sources),
    ("byte-level bpe", encode),
]

# a trained classifier and BPE are beyond SQL: tests hold each stage against a brute-force version
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    stage = Stage(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES[:-1]:
        docs = stage.table(step(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
