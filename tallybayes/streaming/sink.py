"""A sink that a restarted stream writes each row to once, and training from a stream.

A micro-batch that is run again has the same id and the same rows, so all that is
needed is to write each id once. A batch's rows go to a folder with a random name;
then ``commits/<id>.json``, which must be new, names it. What an interrupted batch
left has no commit and is never read. Micro-batches are batch DataFrames here, so any
scorer serves, the sparse and the long one too.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tallybayes.operators.count_store import CountStore
from tallybayes.operators.predict import predict
from tallybayes.operators.prepare import prepare
from tallybayes.operators.train import NBModel
from tallybayes.sources.files import Folder
from tallybayes.sources.spec import DatasetSpec

COMMITS = "commits"


class OnceSink:
    """A table of committed batches in a folder on shared storage."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path, self.folder = spark, path.rstrip("/"), Folder(spark, path)

    def committed(self) -> dict[int, str]:
        """Folder of each committed batch."""
        names = [n for n in self.folder.names(COMMITS) if n.endswith(".json")]
        return {int(n.removesuffix(".json")): self.folder.read(f"{COMMITS}/{n}")["data"] for n in names}

    def write(self, batch: DataFrame, batch_id: int) -> bool:
        """Write a batch unless its id is committed; False if it was."""
        commit = f"{COMMITS}/{batch_id:012d}.json"
        if self.folder.exists(commit):
            return False
        data = f"batch-{batch_id}-{uuid.uuid4().hex}"
        batch.write.parquet(f"{self.path}/{data}")
        if self.folder.write_new(commit, {"data": data, "schema": batch.schema.jsonValue()}):
            return True
        self.folder.delete(data)
        return False

    def read(self) -> DataFrame:
        """The rows of all committed batches; an error before the first one."""
        names = [n for n in self.folder.names(COMMITS) if n.endswith(".json")]
        if not names:
            raise FileNotFoundError(f"no batch is committed in {self.path}")
        commits = [self.folder.read(f"{COMMITS}/{n}") for n in names]
        schema = StructType.fromJson(commits[-1]["schema"])
        return self.spark.read.schema(schema).parquet(*[f"{self.path}/{c['data']}" for c in commits])


def write_predictions_once(
    stream: DataFrame, spec: DatasetSpec, model: NBModel, path: str, checkpoint: str, finish: Callable[[DataFrame], DataFrame] = lambda df: df, **scoring
) -> StreamingQuery:
    """Score a stream into a ``OnceSink``; started again with the same folders it goes on where it stopped."""
    sink = OnceSink(stream.sparkSession, path)

    def one(batch: DataFrame, batch_id: int) -> None:
        sink.write(finish(predict(prepare(batch, spec), model, spec.ids, **scoring)), batch_id)

    return stream.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint).start()


def count_stream(stream: DataFrame, spec: DatasetSpec, store: CountStore, name: str, checkpoint: str) -> StreamingQuery:
    """Add a stream's micro-batches to a count store, each once; ``name`` tells streams of one store apart."""

    def one(batch: DataFrame, batch_id: int) -> None:
        store.add(f"{name}/{batch_id}", prepare(batch, spec))

    return stream.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint).start()
