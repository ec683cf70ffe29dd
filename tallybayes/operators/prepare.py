"""Preparation: canonical labelled form, train/test splits, replication, binning.

The canonical form every other operator consumes is::

    <key columns> | <id columns> | label string | features array<string>

``features`` holds the feature values in the spec's column order, with null
mapped to its own category. Key columns name the model a row belongs to
(``dataset`` by default), so several models can be trained and applied in one
job; they are the join key between test rows and the model.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybayes.functions.exprs import (
    DEFAULT_SEED,
    DEFAULT_TRAIN_RATIO,
    SPLIT_BUCKETS,
    as_category,
    split_bucket,
    split_position,
)
from tallybayes.sources.spec import DatasetSpec

DATASET = "dataset"
LABEL = "label"
FEATURES = "features"
FEAT_IDX = "feat_idx"
VALUE = "value"
COPY = "copy"


def prepare(df: DataFrame, spec: DatasetSpec, keys: dict[str, Column] | None = None) -> DataFrame:
    """Project a named table onto the canonical form (narrow: no shuffle)."""
    key_cols = keys if keys is not None else {DATASET: F.lit(spec.name)}
    return df.select(
        *[c.alias(k) for k, c in key_cols.items()],
        *[F.col(i) for i in spec.ids],
        F.col(spec.label).cast("string").alias(LABEL),
        F.array(*[as_category(F.col(f)) for f in spec.features]).alias(FEATURES),
    )


def hash_split(
    df: DataFrame, ids, train_ratio: float = DEFAULT_TRAIN_RATIO, method: str = "md5"
) -> tuple[DataFrame, DataFrame]:
    """(train, test) by a hash of the row id: deterministic and layout-independent.

    Two filters over the same input; each is a narrow projection, so the
    split adds no shuffle and stays correct when tasks are re-run. ``method``
    picks the hash (see ``split_bucket``).
    """
    cut = round(train_ratio * SPLIT_BUCKETS, 9)
    # a whole percentage needs no more than the bucket
    place = split_bucket if cut == int(cut) else split_position
    at = place(*ids, method=method)
    return df.filter(at < cut), df.filter(at >= cut)


def random_split(
    df: DataFrame, train_ratio: float = DEFAULT_TRAIN_RATIO, seed: int = DEFAULT_SEED
) -> tuple[DataFrame, DataFrame]:
    """(train, test) with Spark's seeded Bernoulli split.

    Each side reads the input anew and draws by partition, so the input has to
    be fixed (a table, not the result of a shuffle): otherwise the sides may
    overlap or lose rows. ``hash_split`` has no such condition.
    """
    train, test = df.randomSplit([train_ratio, 1.0 - train_ratio], seed=seed)
    return train, test


def spread(df: DataFrame, partitions: int) -> DataFrame:
    """The rows dealt evenly to a number of partitions that the caller chooses.

    For small or unsplittable inputs (one gzip file, an inline table), which
    otherwise leave most cores idle; larger inputs keep their scan splits.
    """
    return df.repartition(partitions)


def replicate(df: DataFrame, factor: int | Column, copy_col: str = COPY) -> DataFrame:
    """Every row ``factor`` times, numbered 1..factor in ``copy_col``; none for a factor below 1 or null.

    One narrow Generate instead of ``factor - 1`` chained unions, so the plan
    size does not grow with the factor; ``factor`` may be a column, letting
    each row carry its own replication count.
    """
    n = factor if isinstance(factor, Column) else F.lit(int(factor))
    return df.withColumn(copy_col, F.explode(F.when(n >= 1, F.sequence(F.lit(1).cast("long"), n.cast("long"))))).withColumn(
        copy_col, F.col(copy_col).cast("int")
    )


@dataclass(frozen=True)
class BinEdges:
    """Equal-width bins fitted on a training frame: per column (min, width).

    NaN is a category of its own (``NaN``) and no part of the range.
    """

    bins: int
    edges: dict[str, tuple[float | None, float | None]]

    def column(self, name: str) -> Column:
        """Bin index 0..bins-1 as a string category (null input stays null)."""
        lo, width = self.edges[name]
        x = F.col(name).cast("double")
        if lo is None:
            return F.when(F.isnan(x), F.lit("NaN"))
        if not width:
            idx = F.when(x.isNotNull(), F.lit(0))
        else:
            raw = F.floor((x - F.lit(lo)) / F.lit(width))
            # greatest/least skip nulls, so keep a null input null explicitly
            idx = F.when(x.isNotNull(), F.least(F.greatest(raw, F.lit(0)), F.lit(self.bins - 1)))
        return F.when(F.isnan(x), F.lit("NaN")).otherwise(idx.cast("bigint").cast("string"))

    def apply(self, df: DataFrame, cols=None) -> DataFrame:
        cols = list(cols or self.edges)
        return df.withColumns({c: self.column(c) for c in cols})


def fit_bins(train: DataFrame, cols, bins: int = 3) -> BinEdges:
    """Fit equal-width bins on the training rows (min and max per column).

    One global aggregate returning 2 scalars per column to the driver (the
    same shape as fitting any scaler); applying the bins is a narrow
    projection on train and test alike.
    """
    cols = list(cols)
    aggs = []
    for c in cols:
        x = F.col(c).cast("double")
        x = F.when(~F.isnan(x), x)
        aggs += [F.min(x).alias(f"lo_{c}"), F.max(x).alias(f"hi_{c}")]
    row = train.agg(*aggs).first()
    edges = {}
    for c in cols:
        lo, hi = row[f"lo_{c}"], row[f"hi_{c}"]
        width = None if lo is None else (hi - lo) / bins
        edges[c] = (lo, width)
    return BinEdges(bins, edges)
