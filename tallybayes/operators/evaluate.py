"""Evaluation and inspection: accuracy, class distribution, previews."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tallybayes.operators.prepare import FEATURES, LABEL
from tallybayes.operators.train import NBModel

ROWS = "n_rows"


def accuracy(pred: DataFrame, by=(), label: str = LABEL, prediction: str = "prediction", weight: str | None = None) -> DataFrame:
    """Share of rows whose prediction equals the label, per group (or overall).

    Null-safe equality (a null prediction only matches a null label); no rows
    gives 0.0. A global aggregate is a partial + final aggregate: one row per
    task crosses the shuffle. ``weight`` names a column of row counts, for
    predictions of distinct vectors.
    """
    hit = F.col(prediction).eqNullSafe(F.col(label))
    if weight is not None:
        n, right = F.sum(weight), F.sum(F.when(hit, F.col(weight)).otherwise(0))
        return pred.groupBy(*by).agg(
            F.coalesce(n, F.lit(0)).cast("bigint").alias("n_test"),
            F.coalesce(right, F.lit(0)).cast("bigint").alias("n_correct"),
            F.coalesce(F.try_divide(right.cast("double"), n.cast("double")), F.lit(0.0)).alias("accuracy"),
        )
    return pred.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_test"),
        F.coalesce(F.sum(hit.cast("bigint")), F.lit(0).cast("bigint")).alias("n_correct"),
        F.coalesce(F.avg(hit.cast("double")), F.lit(0.0)).alias("accuracy"),
    )


def distinct_rows(test: DataFrame, keys) -> DataFrame:
    """(keys, features, label, n_rows): equal test rows as one with their number.

    The scan's own tasks aggregate first, so what they hand on is bounded by the
    distinct vectors, however often a vector occurs.
    """
    return test.groupBy(*keys, FEATURES, LABEL).agg(F.count(F.lit(1)).alias(ROWS))


def accuracy_of_distinct(test: DataFrame, model: NBModel, by=(), **scoring) -> DataFrame:
    """``accuracy`` of a model, with each distinct vector and label scored once."""
    from tallybayes.operators.predict import predict

    pred = predict(distinct_rows(test, model.keys), model, [ROWS], **scoring)
    return accuracy(pred, by, weight=ROWS)


def observed(pred: DataFrame, label: str = LABEL, prediction: str = "prediction") -> tuple[DataFrame, Observation]:
    """The predictions, and an observation that counts rows and hits while they are written.

    Whatever job writes (or otherwise runs over) the returned frame first fills
    ``observation.get`` with n_test and n_correct: no second pass over the predictions.
    """
    seen = Observation()
    hit = F.col(prediction).eqNullSafe(F.col(label))
    counts = [F.count(F.lit(1)).alias("n_test"), F.coalesce(F.sum(hit.cast("bigint")), F.lit(0).cast("bigint")).alias("n_correct")]
    return pred.observe(seen, *counts), seen


def write_observed(pred: DataFrame, path: str) -> DataFrame:
    """Write predictions as Parquet; (n_test, n_correct, accuracy) as the writing job itself counted them."""
    out, seen = observed(pred)
    out.write.parquet(path)
    n, right = seen.get["n_test"], seen.get["n_correct"]
    return pred.sparkSession.createDataFrame([(n, right, right / n if n else 0.0)], "n_test bigint, n_correct bigint, accuracy double")


def class_distribution(df: DataFrame, label: str = LABEL) -> DataFrame:
    """(label, count) most frequent first, ties by label."""
    return (
        df.groupBy(label)
        .agg(F.count(F.lit(1)).alias("count"))
        .orderBy(F.desc("count"), F.asc(label))
    )


def sample_rows(df: DataFrame, n: int, order_by) -> DataFrame:
    """First ``n`` rows in a stated order (a deterministic preview; top-k plan)."""
    return df.orderBy(*order_by).limit(n)
