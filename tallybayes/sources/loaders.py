"""Dataset loaders: a file (or the inline rows) split into train and test.

``load_car`` / ``load_mushroom`` read a headerless delimited file with the
dataset's schema (CSV parser or raw line split), or use the inline rows when
no path is given, add a ``row_id`` and split the rows. For a file the id is a
hash of the row's values: the same however the file is cut into partitions,
and equal rows share it (they fall on the same side of a split; scoring does
not need unique ids). The default split is the portable hash of ``row_id``
(80/20); ``split="random"`` is Spark's seeded random split (seed 42). Both
frames are lazy; nothing is collected.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybayes.functions.exprs import DEFAULT_SEED, DEFAULT_TRAIN_RATIO
from tallybayes.sources.delimited import read_csv_table, read_text_table
from tallybayes.sources.fixed import (
    CAR_COLUMNS,
    CAR_ROWS,
    CAR_SPEC,
    MUSHROOM_COLUMNS,
    MUSHROOM_ROWS,
    MUSHROOM_SPEC,
    ROW_ID,
    inline_table,
)
from tallybayes.sources.spec import DatasetSpec


def load_labelled(
    spark: SparkSession,
    columns,
    rows,
    path: str | None = None,
    fmt: str = "csv",
    train_ratio: float = DEFAULT_TRAIN_RATIO,
    split: str = "hash",
    seed: int = DEFAULT_SEED,
) -> tuple[DataFrame, DataFrame]:
    """(train, test) with ``row_id`` and the named all-string columns."""
    from tallybayes.operators.prepare import hash_split, random_split

    if path is None:
        df = inline_table(spark, columns, rows)
    else:
        reader = {"csv": read_csv_table, "text": read_text_table}[fmt]
        df = reader(spark, path, columns)
        df = df.withColumn(ROW_ID, F.xxhash64(*[F.coalesce(F.col(c), F.lit("\x00")) for c in columns]))
        df = df.select(ROW_ID, *columns)
    if split == "hash":
        return hash_split(df, [ROW_ID], train_ratio)
    if split == "random":
        return random_split(df, train_ratio, seed)
    raise ValueError(f"unknown split {split!r}")


def load_car(spark: SparkSession, path: str | None = None, **kw) -> tuple[DataFrame, DataFrame, DatasetSpec]:
    """Car evaluation data (label last): ``(train, test, spec)``."""
    train, test = load_labelled(spark, CAR_COLUMNS, CAR_ROWS, path, **kw)
    return train, test, CAR_SPEC


def load_mushroom(spark: SparkSession, path: str | None = None, **kw) -> tuple[DataFrame, DataFrame, DatasetSpec]:
    """Mushroom data (label first): ``(train, test, spec)``."""
    train, test = load_labelled(spark, MUSHROOM_COLUMNS, MUSHROOM_ROWS, path, **kw)
    return train, test, MUSHROOM_SPEC
