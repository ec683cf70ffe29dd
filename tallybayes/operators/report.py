"""Reports over a table of run records.

A run record is ``dataset, impl, scale, size_label, n_train, train_time,
pred_time, total_time, accuracy``. All reports are aggregates over that table,
so they work the same for three records or for a whole history of runs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# --- fixed values: size labels and implementation names of run records -----
SIZE_LABELS = {1: "Small", 10: "Medium", 50: "Large"}
RDD_BASELINE = "RDD Baseline"
RDD_OPTIMISED = "RDD Optimised"
DF_BASELINE = "DF Baseline"
DF_OPTIMISED = "DF Optimised"
# ---------------------------------------------------------------------------

RECORD_DDL = (
    "dataset string, impl string, scale int, size_label string, n_train bigint, "
    "train_time double, pred_time double, total_time double, accuracy double"
)


def size_label(scale: Column) -> Column:
    """Small / Medium / Large for 1 / 10 / 50, else the scale as text."""
    names = F.create_map(*[x for k, v in SIZE_LABELS.items() for x in (F.lit(k), F.lit(v))])
    return F.coalesce(F.try_element_at(names, scale.cast("int")), scale.cast("string"))


def complete_records(records: DataFrame) -> DataFrame:
    """Fill ``total_time`` (train + predict) and ``size_label`` where missing."""
    cols = records.columns
    out = records
    if "total_time" not in cols and {"train_time", "pred_time"} <= set(cols):
        out = out.withColumn("total_time", F.col("train_time") + F.col("pred_time"))
    if "size_label" not in cols:
        out = out.withColumn("size_label", size_label(F.col("scale")))
    return out


def pivot_table(
    records: DataFrame,
    value: str = "total_time",
    sizes=None,
    rows=("dataset", "impl"),
) -> DataFrame:
    """Implementation x size table; a missing cell stays null.

    Without ``sizes`` the columns are Small, Medium and Large, then every other
    size that has a record, by scale.
    """
    full = complete_records(records)
    if sizes is None:
        named = list(SIZE_LABELS.values())
        scale = F.min("scale") if "scale" in full.columns else F.lit(0)
        other = full.filter(~F.col("size_label").isin(named)).groupBy("size_label").agg(scale.alias("scale"))
        # one row per size; Spark itself refuses a pivot of more than 10,000 columns
        sizes = named + [r["size_label"] for r in other.orderBy("scale", "size_label").collect()]
    return (
        full.groupBy(*rows)
        .pivot("size_label", list(sizes))
        .agg(F.max(value))
        .orderBy(*rows)
    )


# API name -> (baseline implementation, optimised implementation)
DEFAULT_APIS = (("RDD", RDD_BASELINE, RDD_OPTIMISED), ("DF", DF_BASELINE, DF_OPTIMISED))


def speedups(records: DataFrame, value: str = "total_time", apis=DEFAULT_APIS) -> DataFrame:
    """Per dataset and size: base/optimised ratio per API and the faster API.

    ``apis`` is two ``(name, baseline impl, optimised impl)`` triples; the
    first API wins only when its best time is strictly smaller. Only sizes
    where all four implementations have a record are reported.
    """
    rec = complete_records(records)
    (a, a_base, a_opt), (b, b_base, b_opt) = apis

    def cell(impl: str) -> Column:
        return F.max(F.when(F.col("impl") == impl, F.col(value)))

    wide = rec.groupBy("dataset", "size_label").agg(
        cell(a_base).alias("a_base"),
        cell(a_opt).alias("a_opt"),
        cell(b_base).alias("b_base"),
        cell(b_opt).alias("b_opt"),
    )
    complete = wide.filter(
        F.col("a_base").isNotNull()
        & F.col("a_opt").isNotNull()
        & F.col("b_base").isNotNull()
        & F.col("b_opt").isNotNull()
    )
    best_a = F.least("a_base", "a_opt")
    best_b = F.least("b_base", "b_opt")
    return complete.select(
        "dataset",
        "size_label",
        (F.col("a_base") / F.col("a_opt")).alias(f"{a.lower()}_speedup"),
        (F.col("b_base") / F.col("b_opt")).alias(f"{b.lower()}_speedup"),
        F.when(best_a < best_b, F.lit(a)).otherwise(F.lit(b)).alias("winner"),
    )


def mean_winner(records: DataFrame, rdd_col: str = "rdd_total", df_col: str = "df_total") -> DataFrame:
    """Mean total time per API over all runs and the faster one on average."""
    means = records.agg(F.avg(rdd_col).alias("avg_rdd"), F.avg(df_col).alias("avg_df"))
    return means.withColumn(
        "winner", F.when(F.col("avg_rdd") < F.col("avg_df"), F.lit("RDD")).otherwise(F.lit("DataFrame"))
    )


def mean_by(records: DataFrame, by: str = "impl", value: str = "total_time") -> DataFrame:
    """Mean of ``value`` per ``by`` (e.g. per implementation)."""
    return records.groupBy(by).agg(F.avg(value).alias(f"mean_{value}")).orderBy(by)


def accuracy_listing(records: DataFrame) -> DataFrame:
    """Accuracy by dataset, implementation and scale."""
    return records.select("dataset", "impl", "scale", "accuracy").orderBy("dataset", "impl", "scale")
