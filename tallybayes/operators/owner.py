"""Who deletes what operators leave on shared storage.

Operators stage tables and checkpoint frames there, and lazy results read them
later, so no operator can delete its own. A ``Scope`` notes whatever is left while
it is open; closing it, when the results have been used, deletes all of it:

    with Scope(spark):
        predict(...).write.parquet(...)

``owning`` gives a function's result a scope of its own, which ``release(result)``
closes. Nothing is deleted when a Python object merely goes out of sight: frames
derived from it may still read the files.
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession

_OPEN: list[Scope] = []


class Scope:
    """Notes staged folders, durable frames and anything with a ``release`` while open; ``close`` deletes them."""

    def __init__(self, spark: SparkSession):
        self.spark, self.folders, self.frames, self.others = spark, [], [], []

    def __enter__(self) -> Scope:
        _OPEN.append(self)
        return self

    def __exit__(self, *_) -> None:
        self.leave()
        self.close()

    def leave(self) -> None:
        """Note no more; what was noted stays."""
        if self in _OPEN:
            _OPEN.remove(self)

    def close(self) -> None:
        for x in self.others:
            x.release()
        for df in self.frames:
            df.unpersist()
            delete_checkpoint(df)
        for path in self.folders:
            delete_folder(self.spark, path)
        self.folders, self.frames, self.others = [], [], []


def note_folder(path: str) -> None:
    if _OPEN:
        _OPEN[-1].folders.append(path)


def note_frame(df: DataFrame) -> None:
    if _OPEN:
        _OPEN[-1].frames.append(df)


def note(thing) -> None:
    """Something whose ``release`` has to be called."""
    if _OPEN:
        _OPEN[-1].others.append(thing)


def delete_folder(spark: SparkSession, path: str) -> None:
    sc = spark.sparkContext
    folder = sc._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(sc._jsc.hadoopConfiguration()).delete(folder, True)


def delete_checkpoint(df: DataFrame) -> None:
    """Delete the files of a checkpointed frame; nothing for any other."""
    plan = df._jdf.queryExecution().analyzed()
    if not plan.getClass().getSimpleName().startswith("LogicalRDD"):
        return
    file = plan.rdd().getCheckpointFile()
    if file.isDefined():
        delete_folder(df.sparkSession, file.get())


def owning(query):
    """A function (spark, ...) -> DataFrame whose result owns what was staged for it."""

    @functools.wraps(query)
    def run(spark: SparkSession, *args, **kw) -> DataFrame:
        scope = Scope(spark)
        with_scope = scope.__enter__()
        try:
            out = query(spark, *args, **kw)
        except BaseException:
            with_scope.__exit__()
            raise
        scope.leave()
        out._tallybayes_scope = scope
        return out

    return run


def release_result(df: DataFrame) -> None:
    """Close the scope of an ``owning`` function's result."""
    scope = getattr(df, "_tallybayes_scope", None)
    if scope is not None:
        scope.close()
