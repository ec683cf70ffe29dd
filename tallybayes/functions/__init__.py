"""Shared column expressions (Laplace log-probabilities, split hash, argmax)."""

from tallybayes.functions.exprs import (
    DEFAULT_SEED,
    DEFAULT_TRAIN_RATIO,
    NULL_CATEGORY,
    SPLIT_BUCKETS,
    UNKNOWN_LOG_PROB,
    add_arrays,
    argmax,
    as_category,
    fold_sum,
    log_fallback,
    log_likelihood,
    log_prior,
    split_bucket,
    split_key,
)

__all__ = [
    "DEFAULT_SEED",
    "DEFAULT_TRAIN_RATIO",
    "NULL_CATEGORY",
    "SPLIT_BUCKETS",
    "UNKNOWN_LOG_PROB",
    "add_arrays",
    "argmax",
    "as_category",
    "fold_sum",
    "log_fallback",
    "log_likelihood",
    "log_prior",
    "split_bucket",
    "split_key",
]
