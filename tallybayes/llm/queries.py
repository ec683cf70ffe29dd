"""One registered query per operator, with its production parameters, over whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybayes.llm import (
    bpe, embedding_dedup, exact_knn, license_scan, mixing, ngram_lm, periodic_runs, pruned_graph, simhash, substring_dedup, toxicity, url_filter, whitening,
)
from tallybayes.llm._util import prepare
from tallybayes.operators.owner import owning

# fixed values of the contract
URL_RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the words of 50-word windows that start in an earlier document too."""
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text")
    out, r = substring_dedup.dedup(docs, seed=25)
    return out.select(
        "doc_id",
        F.col(f"{r}.n_words").cast("long").alias("n_words"),
        F.col(f"{r}.n_removed").cast("long").alias("n_removed"),
        F.sha2(F.col(f"{r}.kept").cast("binary"), 256).alias("kept_sha256"),
    )


def op2_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents mixed to source targets: how many words the mix takes of each."""
    weights = mixing.quality(_read(spark, sf_dir, "labels"))
    mixed = mixing.mix(_read(spark, sf_dir, "documents"), weights)
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's url under the rules."""
    pages = _read(spark, sf_dir, "pages").select("page_id", "url")
    out = url_filter.verdicts(pages, url_filter.rule_table(spark, URL_RULES))
    return out.select("page_id", "host", "path", "rule", "verdict")


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole text encoded and decoded, as digests."""
    prepare(spark)
    vocabulary, pattern = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    coded = _read(spark, sf_dir, "documents").select("doc_id", bpe.encode(F.col("text"), vocabulary, pattern).alias("code"))
    text = bpe.decode(F.col("code.ids"), vocabulary, pattern)
    return coded.select(
        "doc_id",
        F.col("code.n_tokens").cast("long").alias("n_tokens"),
        F.sha2("code.ids", 256).alias("ids_sha256"),
        F.sha2(text.cast("binary"), 256).alias("decoded_sha256"),
    )


def op5_ngram_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole text scored by a bigram model with deleted interpolation."""
    return ngram_lm.score(_read(spark, sf_dir, "documents").select("doc_id", "text"))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's fingerprint and component, 3-word shingles, 2 bits."""
    out = simhash.near_duplicates(_read(spark, sf_dir, "documents"), words=3, radius=2)
    return out.select("doc_id", simhash.hex_digits(F.col("fp")).alias("fingerprint"), "component_id")


def op7_exact_knn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 highest integer inner products of every 50th vector against all others."""
    rows = _read(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return exact_knn.top_k(rows, F.col("vec_id") % 50 == 0, k=5)


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's licences (names joined by commas, null if none) and highest Dice coefficient."""
    out = license_scan.scan(_read(spark, sf_dir, "documents"))
    return out.select("doc_id", F.array_join("licenses", ",").alias("licenses"), F.round("best_dice", 9).alias("best_dice"))


def op9_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector's links and component at cosine 0.93 within its label."""
    return embedding_dedup.near_duplicates(_read(spark, sf_dir, "embeddings"), cosine=0.93)


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole text scored by a classifier learnt from the labelled rows that are not held out."""
    return toxicity.scored(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))


def op11_pruned_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 nearest vectors of every 100th one, from beam searches of all shards."""
    rows = _read(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return pruned_graph.nearest(rows, F.col("vec_id") % 100 == 0, k=10)


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector on the 4 leading whitened components of the distinct floored vectors."""
    return whitening.whiten(_read(spark, sf_dir, "embeddings").select("vec_id", "embedding"), components=4)


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's runs of repeated words, with the contract's planted tails, as digests."""
    prepare(spark)
    docs = _read(spark, sf_dir, "documents")
    text = periodic_runs.planted(F.col("text"), F.col("doc_id"))
    runs = docs.select("doc_id", periodic_runs.scan(text).alias("found")).select("doc_id", "found.*")
    runs = runs.withColumn("best", periodic_runs.best(F.col("runs")))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    lines = F.concat(F.array_join(lines, "\n"), F.when(F.size("runs") > 0, "\n").otherwise(""))
    return runs.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(lines.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


_ALL = (
    op1_substring_dedup, op2_source_mix, op3_url_filter, op4_bpe, op5_ngram_lm, op6_simhash, op7_exact_knn, op8_license_scan,
    op9_embedding_dedup, op10_toxicity, op11_pruned_graph, op12_whitening, op13_periodic_runs,
)
QUERIES = {f.__name__: owning(f) for f in _ALL}
