"""Column expressions shared by the operators.

Everything here is a built-in Spark expression, so it runs in the JVM and
(except for the higher-order array functions) inside whole-stage codegen.
The classifier has no Python UDF.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values (must equal the reference semantics) ---------------------
# A null feature value is scored as its own category, spelled like Python's
# str(None).
NULL_CATEGORY = "None"
# Log-probability used when neither a likelihood nor a fallback exists for a
# (feature, class): ln(1e-10).
UNKNOWN_LOG_PROB = math.log(1e-10)
# Default training share of the train/test split, and the seed of the random
# split.
DEFAULT_TRAIN_RATIO = 0.8
DEFAULT_SEED = 42
# ---------------------------------------------------------------------------

# Whole-percent buckets of the portable hash split.
SPLIT_BUCKETS = 100


def as_category(c: Column) -> Column:
    """Feature value as a category string; null becomes its own category."""
    return F.coalesce(c.cast("string"), F.lit(NULL_CATEGORY))


def split_key(*cols: str | Column) -> Column:
    """String key of one or more id columns ('|'-joined when several).

    A null id part counts as the empty string, so a row with a null id still
    lands in exactly one side of the split instead of vanishing from both.
    """
    parts = [F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit("")) for c in cols]
    if len(parts) == 1:
        return parts[0]
    return F.concat_ws("|", *parts)


def split_bucket(*cols: str | Column, method: str = "md5") -> Column:
    """Bucket 0..99 of the id.

    ``md5`` (default): first 32 bits of md5(id) modulo 100 — the same
    arithmetic is expressible in DuckDB, so splits can be verified outside
    Spark. ``xxhash64``: Spark's native 64-bit hash modulo 100, about 2.6x
    cheaper per row (measured: 0.29 s vs 0.76 s for 4.8M rows on local[8]);
    a different but equally deterministic split. Either depends only on the
    id value, not on partitioning or row order.
    """
    key = split_key(*cols)
    if method == "xxhash64":
        return F.pmod(F.xxhash64(key), F.lit(SPLIT_BUCKETS)).cast("int")
    if method != "md5":
        raise ValueError(f"unknown split hash {method!r}")
    hex8 = F.substring(F.md5(key), 1, 8)
    return (F.conv(hex8, 16, 10).cast("bigint") % F.lit(SPLIT_BUCKETS)).cast("int")


def split_position(*cols: str | Column, method: str = "md5") -> Column:
    """Place of the id in [0, 100): its bucket, and 32 further bits of the hash as the fraction.

    A row is in the training side when its place is below ``100 * ratio``; for a
    whole percentage that is a comparison of the bucket alone.
    """
    key = split_key(*cols)
    bits = F.xxhash64(key, F.lit(1)) if method == "xxhash64" else F.conv(F.substring(F.md5(key), 9, 8), 16, 10).cast("bigint")
    return split_bucket(*cols, method=method) + F.pmod(bits, F.lit(2**32)) / F.lit(float(2**32))


def log_prior(n_c: Column, n_total: Column, n_classes: Column) -> Column:
    """Laplace-smoothed log prior ln((n_c + 1) / (N + K))."""
    return F.ln((n_c + F.lit(1)) / (n_total + n_classes))


def log_likelihood(n: Column, n_c: Column, n_values: Column) -> Column:
    """Laplace-smoothed log likelihood ln((n + 1) / (n_c + V_f))."""
    return F.ln((n + F.lit(1)) / (n_c + n_values))


def log_fallback(n_c: Column, n_values: Column) -> Column:
    """Log likelihood of a value never seen with the class: ln(1 / (n_c + V_f))."""
    return F.ln(F.lit(1.0) / (n_c + n_values))


def add_arrays(a: Column, b: Column) -> Column:
    """Element-wise sum of two equally long double arrays."""
    return F.zip_with(a, b, lambda x, y: x + y)


def fold_sum(start: Column, parts: Column) -> Column:
    """start + parts[0] + parts[1] + ... element-wise, strictly left to right.

    The fixed order makes the floating-point result independent of how the
    rows were partitioned (prior first, then features in column order).
    """
    return F.aggregate(parts, start, add_arrays)


def argmax(classes: Column, scores: Column, digits: int | None = None) -> tuple[Column, Column]:
    """(best class, best score) of class-aligned arrays.

    Highest score wins; a tie goes to the lowest label because ``classes`` is
    sorted ascending and the index enters the comparison negated. Empty or
    null arrays give null for both. ``digits``: scores are compared rounded.
    """
    if digits is None:
        best = F.array_max(F.transform(scores, lambda s, j: F.struct(s.alias("s"), (-j).alias("neg_j"))))
    else:
        best = F.array_max(F.transform(scores, lambda s, j: F.struct(F.round(s, digits).alias("r"), (-j).alias("neg_j"), s.alias("s"))))
    return F.get(classes, -best["neg_j"]), best["s"]
