"""Labelled datasets built from the driver's Parquet tables.

Each builder returns ``(DataFrame, DatasetSpec)``. Only the needed columns
are selected, so the Parquet scans read a pruned schema; the joins are plain
equi-joins that Catalyst plans (broadcast for the dimension tables, which AQE
decides from their measured size, sort-merge otherwise).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybayes.sources.spec import DatasetSpec

# --- fixed values: marker words of the language dataset --------------------
LANG_WORDS = ("the", "und", "el", "les", "die", "que")
# ---------------------------------------------------------------------------


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def padded_lower(text: Column) -> Column:
    """Lower-cased text with one space added at both ends."""
    return F.lower(F.concat(F.lit(" "), text, F.lit(" ")))


def word_flag(padded: Column, word: str) -> Column:
    """'y' when ``word`` occurs space-delimited in the padded text, else 'n'."""
    return F.when(padded.contains(f" {word} "), F.lit("y")).otherwise(F.lit("n"))


def documents_lang(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DatasetSpec]:
    """Documents labelled by language; features flag six marker words."""
    docs = read_table(spark, sf_dir, "documents")
    feats = [f"w_{w}" for w in LANG_WORDS]
    # the padded text is projected once and referenced by every flag, so
    # Catalyst keeps it as one expression instead of inlining it six times
    padded = docs.select("doc_id", "lang", padded_lower(F.col("text")).alias("_padded"))
    df = padded.select(
        "doc_id",
        "lang",
        *[word_flag(F.col("_padded"), w).alias(f) for w, f in zip(LANG_WORDS, feats)],
    )
    return df, DatasetSpec("documents_lang", tuple(feats), "lang", ("doc_id",))


def orders_set(
    spark: SparkSession, sf_dir: str, with_region: bool = False, extra: tuple[str, ...] = ()
) -> tuple[DataFrame, DatasetSpec]:
    """Orders with their customer's segment and nation; label is the priority. ``extra`` order columns are kept."""
    orders = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority"
    )
    customer = read_table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment", "c_nationkey")
    nation = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    df = orders.join(customer, orders.o_custkey == customer.c_custkey).join(
        nation, F.col("c_nationkey") == nation.n_nationkey
    )
    cols = ["o_orderkey", "o_orderpriority", "o_orderstatus", "c_mktsegment", "n_name", *extra]
    if with_region:
        region = read_table(spark, sf_dir, "region").select("r_regionkey", "r_name")
        df = df.join(region, F.col("n_regionkey") == region.r_regionkey)
        cols.append("r_name")
    spec = DatasetSpec(
        "orders", ("o_orderstatus", "c_mktsegment", "n_name"), "o_orderpriority", ("o_orderkey",)
    )
    return df.select(*cols), spec


LINEITEM_IDS = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


def lineitem_part(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DatasetSpec]:
    """Line items with their part's brand and type; label is the return flag."""
    li = read_table(spark, sf_dir, "lineitem").select(*LINEITEM_IDS, "l_returnflag", "l_linestatus")
    part = read_table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_type")
    df = li.join(part, li.l_partkey == part.p_partkey).select(
        *LINEITEM_IDS,
        "l_returnflag",
        "l_linestatus",
        F.col("l_linenumber").cast("string").alias("l_linenum"),
        "p_brand",
        "p_type",
    )
    spec = DatasetSpec(
        "lineitem", ("l_linestatus", "l_linenum", "p_brand", "p_type"), "l_returnflag", LINEITEM_IDS
    )
    return df, spec


def events_set(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DatasetSpec]:
    """Events labelled by type; features are props, user and hour of day."""
    ev = read_table(spark, sf_dir, "events")
    df = ev.select(
        "event_id",
        "event_type",
        "props",
        F.col("user_id").cast("string").alias("user"),
        F.hour("ts").cast("string").alias("hour"),
    )
    return df, DatasetSpec("events", ("props", "user", "hour"), "event_type", ("event_id",))


def documents_labelled(spark: SparkSession, sf_dir: str, label: str = "quality") -> tuple[DataFrame, DatasetSpec]:
    """Labelled documents (inner join with ``labels``); label ``quality`` or ``toxic``.

    ``n_chars`` is numeric: bin it (``fit_bins`` on the training rows) before
    training.
    """
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars")
    labels = read_table(spark, sf_dir, "labels").select("doc_id", label)
    df = docs.join(labels, "doc_id")
    return df, DatasetSpec(f"documents_{label}", ("lang", "source", "n_chars"), label, ("doc_id",))


def documents_quality(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DatasetSpec]:
    return documents_labelled(spark, sf_dir, "quality")


def documents_toxic(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DatasetSpec]:
    return documents_labelled(spark, sf_dir, "toxic")


# name -> builder(spark, sf_dir) -> (DataFrame, DatasetSpec)
DATASETS = {
    "documents_lang": documents_lang,
    "orders": orders_set,
    "lineitem": lineitem_part,
    "events": events_set,
    "documents_quality": documents_quality,
    "documents_toxic": documents_toxic,
}


def load_dataset(spark: SparkSession, sf_dir: str, name: str) -> tuple[DataFrame, DatasetSpec]:
    """Build a registered labelled dataset by name."""
    try:
        return DATASETS[name](spark, sf_dir)
    except KeyError:
        raise KeyError(f"unknown dataset {name!r}; known: {sorted(DATASETS)}") from None
