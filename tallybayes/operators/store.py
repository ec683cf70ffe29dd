"""A trained model on disk: tables, and a manifest that is written last.

``save_model`` writes the counts, the class header, the folded row of the map
scorer where it is small, and the dense likelihoods as a table bucketed and
sorted by value, then the manifest: schemas, model sizes and the bytes of each file. A
folder without a manifest is no model, so a save that was interrupted leaves
nothing that could be loaded, and ``load_model`` refuses a folder whose files
are not those of the manifest. A loaded model knows its sizes, so scoring starts
without a statistics job, and reads the lookup table without an exchange.
"""

from __future__ import annotations

import uuid
from dataclasses import asdict

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from tallybayes.operators.predict import MAX_MAP_BYTES, MAX_MAP_VALUES, SPARSE_CLASSES, _wide_features
from tallybayes.operators.prepare import VALUE
from tallybayes.operators.train import ModelStats, NBModel
from tallybayes.sources.files import Folder

MANIFEST = "MANIFEST.json"
FORMAT = 1
BUCKET_BYTES = 128 * 1024 * 1024


class ModelNotWhole(ValueError):
    """The folder holds no complete model."""


def save_model(model: NBModel, path: str, buckets: int | None = None) -> None:
    """Write a model to a folder that holds none yet.

    ``buckets`` of the lookup table default to the session's shuffle partitions,
    or more where a bucket would exceed 128 MiB.
    """
    spark = model.counts.sparkSession
    folder = Folder(spark, path)
    if folder.exists(MANIFEST):
        raise FileExistsError(f"{path} holds a model already")
    data = f"data-{uuid.uuid4().hex}"  # of an interrupted save nothing is reused
    st = model.stats()
    tables = {"counts": model.counts}
    if st.max_classes <= SPARSE_CLASSES:
        tables["header"] = model.score_header
    narrow = [i for i in range(len(st.features)) if i not in _wide_features(st, MAX_MAP_BYTES, MAX_MAP_VALUES)]
    if narrow and "header" in tables:
        tables["folded"] = model.folded(narrow)
    for name, df in tables.items():
        df.write.parquet(f"{path}/{data}/{name}")
    schemas = {name: df.schema.jsonValue() for name, df in tables.items()}
    lookup = None
    if "header" in tables:
        least = int(spark.conf.get("spark.sql.shuffle.partitions"))
        n = buckets or max(least, -(-st.dense_bytes // BUCKET_BYTES))
        # the columns that a lookup joins on: one model's key is a constant
        by = [VALUE] if st.n_models <= 1 else [*model.keys, VALUE]
        dense = model.dense_likelihood
        name = f"tallybayes_{uuid.uuid4().hex}"
        dense.repartition(n, *by).write.bucketBy(n, *by).sortBy(*by).option("path", f"{path}/{data}/lookup").format("parquet").saveAsTable(name)
        spark.sql(f"DROP TABLE {name}")  # external: the files stay
        schemas["lookup"] = dense.schema.jsonValue()
        lookup = {"buckets": n, "by": by}
    content = {
        "format": FORMAT,
        "keys": model.keys,
        "data": data,
        "schemas": schemas,
        "lookup": lookup,
        "narrow": narrow,
        "stats": asdict(st),
        "files": folder.sizes(data),
    }
    if not folder.write_new(MANIFEST, content):
        raise FileExistsError(f"{path} holds a model already")


class StoredModel(NBModel):
    """A model whose derived frames are read instead of computed."""

    def __init__(self, spark: SparkSession, path: str, manifest: dict):
        self.path, self.manifest, self._tables = path, manifest, {}
        super().__init__(self._read(spark, "counts"), manifest["keys"])
        st = dict(manifest["stats"])
        st["features"] = tuple(tuple(x) for x in st["features"])
        self._stats = ModelStats(**st)

    def _read(self, spark: SparkSession, name: str) -> DataFrame:
        schema = StructType.fromJson(self.manifest["schemas"][name])
        return spark.read.schema(schema).parquet(f"{self.path}/{self.manifest['data']}/{name}")

    @property
    def score_header(self) -> DataFrame:
        if "header" not in self.manifest["schemas"]:
            return NBModel.score_header.func(self)
        return self._read(self.counts.sparkSession, "header")

    @property
    def lookup(self) -> DataFrame:
        """The bucketed table: a merge join on its bucket columns reads it without an exchange."""
        spec = self.manifest["lookup"]
        if spec is None:
            return self.dense_likelihood
        spark = self.counts.sparkSession
        if "lookup" not in self._tables:
            name = f"tallybayes_{uuid.uuid4().hex}"
            schema = StructType.fromJson(self.manifest["schemas"]["lookup"])
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
            by = ", ".join(f"`{c}`" for c in spec["by"])
            spark.sql(
                f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY ({by}) SORTED BY ({by}) "
                f"INTO {spec['buckets']} BUCKETS LOCATION '{self.path}/{self.manifest['data']}/lookup'"
            )
            self._tables["lookup"] = name
        return spark.table(self._tables["lookup"])

    def folded(self, narrow) -> DataFrame:
        if "folded" in self.manifest["schemas"] and list(narrow) == self.manifest["narrow"]:
            return self._read(self.counts.sparkSession, "folded")
        return super().folded(narrow)

    def release(self) -> None:
        """Forget the session's entry of the lookup table; the stored files stay."""
        for name in self._tables.values():
            self.counts.sparkSession.sql(f"DROP TABLE IF EXISTS {name}")
        self._tables.clear()


def load_model(spark: SparkSession, path: str) -> StoredModel:
    """The model of a folder; no Spark job runs. ``ModelNotWhole`` without a manifest or with other files than it lists."""
    folder = Folder(spark, path)
    manifest = folder.read(MANIFEST)
    if manifest is None:
        raise ModelNotWhole(f"{path} has no manifest: the model was not saved to its end")
    if manifest.get("format") != FORMAT:
        raise ModelNotWhole(f"{path} has format {manifest.get('format')!r}, expected {FORMAT}")
    have = folder.sizes(manifest["data"])
    if have != manifest["files"]:
        odd = sorted(k for k in {*have, *manifest["files"]} if have.get(k) != manifest["files"].get(k))
        raise ModelNotWhole(f"{path} differs from its manifest in {len(odd)} files, such as {odd[0]}")
    return StoredModel(spark, path, manifest)
