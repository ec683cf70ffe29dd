"""Operators: preparation, training, scoring, evaluation, reports."""

from tallybayes.operators.count_store import CountStore
from tallybayes.operators.evaluate import (
    accuracy,
    accuracy_of_distinct,
    class_distribution,
    distinct_rows,
    observed,
    sample_rows,
    write_observed,
)
from tallybayes.operators.owner import Scope, owning
from tallybayes.operators.predict import class_scores, choose_scorer, predict, score_arrays
from tallybayes.operators.prepare import (
    BinEdges,
    spread,
    fit_bins,
    hash_split,
    prepare,
    random_split,
    replicate,
)
from tallybayes.operators.ranks import CutBins, fit_mdl_bins, fit_quantile_bins, rank_search, split_stratified
from tallybayes.operators.store import ModelNotWhole, load_model, save_model
from tallybayes.operators.train import NBModel, ModelStats, count_features, long_form, release, train

__all__ = [
    "BinEdges",
    "CountStore",
    "CutBins",
    "ModelNotWhole",
    "ModelStats",
    "NBModel",
    "Scope",
    "accuracy",
    "accuracy_of_distinct",
    "choose_scorer",
    "class_distribution",
    "class_scores",
    "count_features",
    "distinct_rows",
    "spread",
    "fit_bins",
    "fit_mdl_bins",
    "fit_quantile_bins",
    "hash_split",
    "load_model",
    "long_form",
    "observed",
    "owning",
    "predict",
    "prepare",
    "random_split",
    "rank_search",
    "release",
    "replicate",
    "sample_rows",
    "save_model",
    "score_arrays",
    "split_stratified",
    "train",
    "write_observed",
]
