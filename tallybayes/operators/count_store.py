"""Counts kept up to date: batches are added and withdrawn, each once.

The counts of a table are the sum of the counts of its parts, and a sum can be
taken back, so a model need not be trained anew when rows arrive or go. The store
is a folder on shared storage:

* ``data/<random>/``: the counts of one batch (or of a snapshot), a Parquet table;
* ``log/<number>.json``: what happened, in order: a batch added or withdrawn, a
  snapshot taken. An entry is written whole and must be new (``Folder.write_new``),
  so of two writers one goes next and the other looks again.

A batch exists once its entry does: data without an entry is the rest of an
interrupted write and is never read. A batch id counts once, whatever is delivered
again; a withdrawn id stays withdrawn. ``version`` is the number of
entries, and every version can still be read.
"""

from __future__ import annotations

import uuid
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

from tallybayes.operators.prepare import DATASET, FEAT_IDX, LABEL, VALUE
from tallybayes.operators.train import N, NBModel, count_features, make_durable
from tallybayes.sources.files import Folder

LOG, DATA = "log", "data"


class CountStore:
    """The count store of a folder; ``keys`` name string columns that tell models apart."""

    def __init__(self, spark: SparkSession, path: str, keys=(DATASET,)):
        self.spark, self.path, self.keys = spark, path.rstrip("/"), list(keys)
        self.folder = Folder(spark, self.path)

    @cached_property
    def schema(self) -> StructType:
        kinds = [(k, StringType()) for k in self.keys]
        kinds += [(FEAT_IDX, IntegerType()), (VALUE, StringType()), (LABEL, StringType()), (N, LongType())]
        return StructType([StructField(*k) for k in kinds])

    # -- the log ------------------------------------------------------------------
    def _entry(self, number: int) -> str:
        return f"{LOG}/{number:012d}.json"

    def _log(self, version: int | None = None) -> list[dict]:
        names = [n for n in self.folder.names(LOG) if n.endswith(".json")]
        return [self.folder.read(f"{LOG}/{n}") for n in names[:version]]

    def _append(self, entry: dict, fits) -> bool:
        """Write the next entry; False if, by what other writers wrote meanwhile, it no longer ``fits``."""
        while True:
            log = self._log()
            if not fits(log):
                return False
            if self.folder.write_new(self._entry(len(log)), entry):
                return True

    @property
    def version(self) -> int:
        return len(self._log())

    def batches(self, version: int | None = None) -> dict[str, str]:
        """Data folder of each batch that counts, by batch id."""
        live = {}
        for e in self._log(version):
            if e["op"] == "add":
                live[e["batch"]] = e["data"]
            elif e["op"] == "withdraw":
                live.pop(e["batch"], None)
        return live

    # -- changes --------------------------------------------------------------------
    def add(self, batch: str, prepared: DataFrame, weight: str | None = None) -> bool:
        """Count the canonical rows of a batch; False if the id came before, when nothing is read or written."""

        def new(log):
            return not any(e.get("batch") == batch for e in log)

        if not new(self._log()):
            return False
        data = f"{DATA}/{uuid.uuid4().hex}"
        counts = count_features(prepared, self.keys, weight)
        counts = counts.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in self.schema])
        counts.write.parquet(f"{self.path}/{data}")
        if self._append({"op": "add", "batch": batch, "data": data}, new):
            return True
        self.folder.delete(data)  # another writer was first
        return False

    def withdraw(self, batch: str) -> bool:
        """Take a batch's rows back; False if no such batch counts."""

        def counts(log):
            ops = [e["op"] for e in log if e.get("batch") == batch]
            return ops == ["add"]

        return self._append({"op": "withdraw", "batch": batch}, counts)

    def snapshot(self) -> None:
        """Store the present sum, so that later reads don't go back to the single batches."""
        log = self._log()
        data = f"{DATA}/{uuid.uuid4().hex}"
        self.counts(len(log)).write.parquet(f"{self.path}/{data}")
        entry = {"op": "snapshot", "data": data, "upto": len(log)}
        self._append(entry, lambda _: True)

    def vacuum(self) -> int:
        """Delete what interrupted writes left, and say how many folders; not while a writer runs."""
        known = {e["data"] for e in self._log() if "data" in e}
        left = [n for n in self.folder.names(DATA) if f"{DATA}/{n}" not in known]
        for n in left:
            self.folder.delete(f"{DATA}/{n}")
        return len(left)

    # -- reading --------------------------------------------------------------------
    def _read(self, folders: list[str], sign: int) -> DataFrame | None:
        if not folders:
            return None
        df = self.spark.read.schema(self.schema).parquet(*[f"{self.path}/{f}" for f in folders])
        return df if sign > 0 else df.withColumn(N, -F.col(N))

    def counts(self, version: int | None = None) -> DataFrame:
        """(keys, feat_idx, value, label, n) over the batches that count, as ``count_features`` of all their rows.

        Reads the last snapshot, the batches added since and, with a minus, those
        of it that were withdrawn since.
        """
        log = self._log(version)
        at = max((i for i, e in enumerate(log) if e["op"] == "snapshot"), default=None)
        base, upto = ([], 0) if at is None else ([log[at]["data"]], log[at]["upto"])
        had, now = self.batches(upto), self.batches(len(log))
        plus = base + [d for b, d in now.items() if b not in had]
        minus = [d for b, d in had.items() if b not in now]
        parts = [p for p in (self._read(plus, 1), self._read(minus, -1)) if p is not None]
        if not parts:
            return self.spark.createDataFrame([], self.schema)
        out = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
        out = out.groupBy(*self.keys, FEAT_IDX, VALUE, LABEL).agg(F.sum(N).alias(N))
        return out.filter(F.col(N) > 0)  # what was withdrawn leaves no class and no value behind

    def model(self, version: int | None = None) -> NBModel:
        """The model of a version: as trained on the rows of its batches."""
        return NBModel(make_durable(self.counts(version)), self.keys)
