"""Training: one counting pass, then a model made of small DataFrames.

The only pass over the training data is::

    posexplode_outer(features) -> groupBy(keys, feat_idx, value, label).count()

(or ``sum(weight)`` with a multiplicity column).

Spark runs it as a partial (map-side) aggregate, a shuffle of at most one row
per distinct (key, feature, value, class) per task, and a final aggregate, so
a hot value or class costs nothing extra. Everything else is derived from the
count frame, whose size depends on the vocabulary, not on the row count:

* class counts are the counts of feature 0 summed per class (every row has
  exactly one value for each feature), so no second scan is needed;
* the vocabulary size V_f is the number of per-value rows of a feature
  (one grouping of the count frame, shared with the likelihood arrays);
* prior, likelihood and fallback are column expressions over joins with
  per-model dimension frames, broadcast behind bounds from ``stats()``.

The count frame is checkpointed to ``spark.checkpoint.dir`` when the session
names one (so lost executors never force a re-scan of the training data),
else persisted.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from functools import cached_property

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybayes.functions.exprs import log_fallback, log_likelihood, log_prior
from tallybayes.operators.owner import delete_checkpoint, delete_folder, note_folder, note_frame, release_result
from tallybayes.operators.prepare import DATASET, FEAT_IDX, FEATURES, LABEL, VALUE

N = "n"
# per-model dimension frames (classes, vocabulary, headers) are broadcast into
# joins with the larger count-derived frames when their size, known from
# stats(), is below this bound; beyond it the join is left to AQE (skew split)
MAX_DIM_BROADCAST_BYTES = 256 * 1024 * 1024
# models up to this (folded) size are derived from counts read as one partition:
# no grouping or join of the derivation then needs an exchange
COLOCATE_MAX_BYTES = 64 * 1024 * 1024


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The session's shared checkpoint folder, if any (never invented here)."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return sc.getCheckpointDir()
    return None


def make_durable(df: DataFrame) -> DataFrame:
    """Reliable checkpoint when a checkpoint folder is configured, else persist."""
    out = df.checkpoint(eager=True) if checkpoint_dir(df.sparkSession) else df.persist(StorageLevel.MEMORY_AND_DISK)
    note_frame(out)
    return out


def shared_folder(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the checkpoint folder, which all executors share.

    Without one, a local master (one machine) uses a folder beside its
    warehouse; off local mode that is refused, since each executor would write
    to its own disk and the read-back would be incomplete.
    """
    base = checkpoint_dir(spark)
    if base is None:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        base = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/checkpoints"
    path = f"{base.rstrip('/')}/tallybayes-{name}-{uuid.uuid4().hex}"
    note_folder(path)
    return path


def stage_table(df: DataFrame, name: str = "staged") -> DataFrame:
    """Write ``df`` as a Parquet table in the shared folder and read it back.

    Cuts the lineage like a checkpoint, but the result is columnar and
    compressed, so later reads prune columns and push filters. Each call gets
    a fresh sub-folder; ``release`` removes it.
    """
    path = shared_folder(df.sparkSession, name)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)  # no job to find the schema
    out._tallybayes_folder = path
    return out


def release(*frames: DataFrame) -> None:
    """Give up durable frames: unpersist them, delete their checkpoint or the folder of a staged table, and all that a query's result owns."""
    for df in frames:
        df.unpersist()
        delete_checkpoint(df)
        path = getattr(df, "_tallybayes_folder", None)
        if path:
            delete_folder(df.sparkSession, path)
        release_result(df)


def long_form(prepared: DataFrame, keep=()) -> DataFrame:
    """Wide to long in one narrow Generate: one row per (row, feature).

    ``posexplode_outer`` on purpose: the plain generator makes Catalyst infer
    a ``size(features) > 0`` filter, which re-evaluates every feature
    expression a second time; feature arrays are never empty, so the rows
    are the same.
    """
    return prepared.select(*keep, F.posexplode_outer(FEATURES).alias(FEAT_IDX, VALUE))


def count_features(prepared: DataFrame, keys=(DATASET,), weight: str | None = None) -> DataFrame:
    """(keys, feat_idx, value, label, n): the sufficient statistics.

    With ``weight`` each row counts that many times (a multiplicity column):
    the counts equal those of the rows replicated ``weight`` times, without
    materialising the copies.
    """
    rows = prepared.filter(F.col(LABEL).isNotNull())
    if weight is not None:
        rows = rows.filter(F.col(weight) > 0)  # zero copies leave no class and no value behind
    keep = (*keys, LABEL) if weight is None else (*keys, LABEL, weight)
    n = F.count(F.lit(1)) if weight is None else F.sum(F.col(weight).cast("bigint"))
    return long_form(rows, keep=keep).groupBy(*keys, FEAT_IDX, VALUE, LABEL).agg(n.alias(N))


def _class_counts(counts: DataFrame, keys) -> DataFrame:
    """(keys, label, n_c): counts of feature 0 summed per class."""
    return counts.filter(F.col(FEAT_IDX) == 0).groupBy(*keys, LABEL).agg(F.sum(N).alias("n_c"))


@dataclass(frozen=True)
class ModelStats:
    """Driver-side scalars used to pick a scoring strategy; sizes count the bytes of values and labels."""

    n_models: int
    max_classes: int
    max_values: int
    n_entries: int
    dense_cells: int
    min_features: int = 0
    max_features: int = 0
    value_bytes: int = 0
    label_bytes: int = 0
    # per feature position: most values in a model, bytes of its dense frame over all models
    features: tuple[tuple[int, int], ...] = ()

    @property
    def header_bytes(self) -> int:
        """Size of the per-model headers: classes, priors, fallback arrays."""
        return self.n_models * (64 + self.max_classes * (80 + 8 * self.max_features)) + self.label_bytes

    @property
    def dense_bytes(self) -> int:
        """Size of the dense likelihood frame (one K-array per value)."""
        return 8 * self.dense_cells + 64 * self.n_entries + self.value_bytes

    @property
    def map_bytes(self) -> int:
        """Size of the folded one-row-per-model form."""
        return self.dense_bytes + self.header_bytes


class NBModel:
    """Categorical Naive Bayes model with Laplace (+1) smoothing.

    All parts are DataFrames derived lazily from ``counts``; ``keys`` name the
    model a row belongs to (several models can live in one set of frames).
    """

    def __init__(self, counts: DataFrame, keys=(DATASET,)):
        self.counts = counts
        self.keys = list(keys)

    @cached_property
    def _colocated(self) -> bool:
        return self.stats().map_bytes <= COLOCATE_MAX_BYTES

    @cached_property
    def _base(self) -> DataFrame:
        """The count frame every derived part reads.

        For a model that ``stats()`` proves small, the counts are read as one
        partition: Spark then sees every later grouping and join as already
        clustered, so the whole derivation runs without an exchange, in the
        job that uses it. Larger models keep the count frame's own
        partitioning and use broadcast dimension joins.
        """
        if self._colocated:
            return self.counts.coalesce(1)
        return self.counts

    def _dim(self, df: DataFrame, rows_per_model: int, row_bytes: int) -> DataFrame:
        """Broadcast a per-model dimension frame whose size ``stats()`` bounds.

        These frames are joined on the model key (plus class or feature),
        which has few distinct values: without a broadcast each model's rows
        would meet in one task. AQE itself declines to broadcast such a side
        (all of it lands in one shuffle partition), so the hint is explicit.
        """
        st = self.stats()
        if st.n_models * max(rows_per_model, 1) * row_bytes <= MAX_DIM_BROADCAST_BYTES:
            return F.broadcast(df)
        return df

    # -- relational parts --------------------------------------------------
    @cached_property
    def classes(self) -> DataFrame:
        """(keys, label, n_c)."""
        return _class_counts(self._base, self.keys)

    @cached_property
    def totals(self) -> DataFrame:
        """(keys, n_total, n_classes): training rows N and classes K."""
        return self.classes.groupBy(*self.keys).agg(
            F.sum("n_c").alias("n_total"), F.count(F.lit(1)).alias("n_classes")
        )

    @cached_property
    def prior(self) -> DataFrame:
        """(keys, label, n_c, log_prior)."""
        return self.classes.join(self._dim(self.totals, 1, 64), self.keys).select(
            *self.keys,
            LABEL,
            "n_c",
            log_prior(F.col("n_c"), F.col("n_total"), F.col("n_classes")).alias("log_prior"),
        )

    @cached_property
    def vocabulary(self) -> DataFrame:
        """(keys, feat_idx, n_values): exact distinct values per feature.

        Counted as the rows of ``_by_value`` (one row per distinct value), so
        the shuffle that groups values is shared with the likelihood arrays
        instead of a separate two-phase distinct count.
        """
        return self._by_value.groupBy(*self.keys, FEAT_IDX).agg(F.count(F.lit(1)).alias("n_values"))

    @cached_property
    def _by_value(self) -> DataFrame:
        """(keys, feat_idx, value, _by_class): class -> count map per value."""
        return self._base.groupBy(*self.keys, FEAT_IDX, VALUE).agg(
            F.map_from_entries(F.collect_list(F.struct(LABEL, N))).alias("_by_class")
        )

    @cached_property
    def likelihood(self) -> DataFrame:
        """(keys, feat_idx, value, label, n, log_lik) for every stored count."""
        st = self.stats()
        return (
            self._base.join(self._dim(self.classes, st.max_classes, 64), [*self.keys, LABEL])
            .join(self._dim(self.vocabulary, st.max_features, 48), [*self.keys, FEAT_IDX])
            .select(
                *self.keys,
                FEAT_IDX,
                VALUE,
                LABEL,
                N,
                log_likelihood(F.col(N), F.col("n_c"), F.col("n_values")).alias("log_lik"),
            )
        )

    # -- class-aligned array parts (what the scorers use) -------------------
    @cached_property
    def header(self) -> DataFrame:
        """One row per model: classes sorted ascending, their counts and priors."""
        cls = F.array_sort(F.collect_list(F.struct(LABEL, "n_c", "log_prior")))
        return (
            self.prior.groupBy(*self.keys)
            .agg(cls.alias("_cls"))
            .select(
                *self.keys,
                F.col("_cls")[LABEL].alias("classes"),
                F.col("_cls")["n_c"].alias("class_counts"),
                F.col("_cls")["log_prior"].alias("prior"),
            )
        )

    @cached_property
    def _feature_header(self) -> DataFrame:
        """(keys, feat_idx, n_values, classes, class_counts, log_fallbacks)."""
        hdr = self._dim(self.header.drop("prior"), 1, 64 + 48 * self.stats().max_classes)
        return self.vocabulary.join(hdr, self.keys).withColumn(
            "log_fallbacks",
            F.transform("class_counts", lambda n_c: log_fallback(n_c, F.col("n_values"))),
        )

    @cached_property
    def fallback_arrays(self) -> DataFrame:
        """(keys, feat_idx, log_fallbacks) aligned with ``header.classes``."""
        return self._feature_header.select(*self.keys, FEAT_IDX, "log_fallbacks")

    @cached_property
    def fallback(self) -> DataFrame:
        """(keys, feat_idx, label, log_fallback): one row per feature and class, by a join on the model key."""
        classes = self._dim(self.classes, self.stats().max_classes, 64)
        return self.vocabulary.join(classes, self.keys).select(
            *self.keys, FEAT_IDX, LABEL, log_fallback(F.col("n_c"), F.col("n_values")).alias("log_fallback")
        )

    @cached_property
    def dense_likelihood(self) -> DataFrame:
        """(keys, feat_idx, value, log_liks): log likelihood for every class.

        A class never seen with the value gets n = 0, which is exactly the
        fallback ln(1 / (n_c + V_f)).
        """
        return self._dense_with_fallbacks.drop("log_fallbacks")

    @property
    def lookup(self) -> DataFrame:
        """The frame that scorers look values up in: ``dense_likelihood``, or the stored table of a loaded model."""
        return self.dense_likelihood

    @cached_property
    def _dense_with_fallbacks(self) -> DataFrame:
        """``dense_likelihood`` plus the feature's ``log_fallbacks`` array."""
        st = self.stats()
        fh = self._dim(
            self._feature_header.select(
                *self.keys, FEAT_IDX, "n_values", "classes", "class_counts", "log_fallbacks"
            ),
            st.max_features,
            64 + 56 * st.max_classes,
        )
        liks = F.transform(
            "classes",
            lambda c, j: log_likelihood(
                F.coalesce(F.try_element_at(F.col("_by_class"), c), F.lit(0).cast("bigint")),
                F.get(F.col("class_counts"), j),
                F.col("n_values"),
            ),
        )
        return self._by_value.join(fh, [*self.keys, FEAT_IDX]).select(
            *self.keys, FEAT_IDX, VALUE, liks.alias("log_liks"), "log_fallbacks"
        )

    @cached_property
    def score_header(self) -> DataFrame:
        """One row per model: sorted classes, priors and ``fallback`` map.

        ``fallback``: map<feat_idx, array<double>> aligned with ``classes``.
        Size bounded by ``stats().header_bytes``.
        """
        fb = self.fallback_arrays.groupBy(*self.keys).agg(
            F.map_from_entries(F.collect_list(F.struct(FEAT_IDX, "log_fallbacks"))).alias("fallback")
        )
        st = self.stats()
        fb = self._dim(fb, 1, 64 + st.max_features * (16 + 8 * st.max_classes))
        return self.header.select(*self.keys, "classes", "prior").join(fb, self.keys, "left")

    @cached_property
    def map_model(self) -> DataFrame:
        """``folded`` with every feature."""
        return self.folded(range(self.stats().max_features))

    def folded(self, narrow) -> DataFrame:
        """``score_header`` plus ``lik``: map<feat_idx, map<value, array<double>>> of the ``narrow`` features.

        Its size is bounded by the scorer, which sums ``stats().features``
        before it builds or broadcasts this.
        """
        if self._colocated:
            return self._folded_at_once(narrow)
        # each feature's group carries its fallback array, so likelihood and
        # fallback maps fold in the same two aggregations
        inside = F.col(FEAT_IDX).isin([int(i) for i in narrow])
        per_feat = self._dense_with_fallbacks.groupBy(*self.keys, FEAT_IDX).agg(
            F.map_from_entries(F.collect_list(F.when(inside, F.struct(VALUE, "log_liks")))).alias("_lik"),
            F.first("log_fallbacks").alias("_fb"),
        )
        folded = per_feat.groupBy(*self.keys).agg(
            F.map_from_entries(F.collect_list(F.struct(FEAT_IDX, "_lik"))).alias("lik"),
            F.map_from_entries(F.collect_list(F.struct(FEAT_IDX, "_fb"))).alias("fallback"),
        )
        st = self.stats()
        folded = self._dim(folded, 1, st.map_bytes // max(st.n_models, 1))
        return self.header.select(*self.keys, "classes", "prior").join(folded, self.keys, "left")

    def _folded_at_once(self, narrow) -> DataFrame:
        """``folded`` of small models, without a join.

        The counts are one partition, so groupings need no exchange; class totals
        and features meet as rows of one union rather than in a join, which would
        be a broadcast, and a job of its own, for every frame joined.
        """
        k = self.keys
        cls = self.classes.groupBy(*k).agg(F.array_sort(F.collect_list(F.struct(LABEL, "n_c"))).alias("_cls"))
        values = (
            self._by_value.filter(F.col(FEAT_IDX).isNotNull())
            .groupBy(*k, FEAT_IDX)
            .agg(F.collect_list(F.struct(VALUE, "_by_class")).alias("_values"))
            .select(*k, F.struct(FEAT_IDX, "_values").alias("_feature"))
        )
        rows = (
            cls.unionByName(values, allowMissingColumns=True)
            .coalesce(1)
            .groupBy(*k)
            .agg(F.first("_cls", ignorenulls=True).alias("_cls"), F.collect_list("_feature").alias("_features"))
            .filter(F.col("_cls").isNotNull())
        )
        total = F.aggregate("_cls", F.lit(0).cast("bigint"), lambda s, c: s + c["n_c"])

        def fallbacks(f):
            return F.transform("_cls", lambda c: log_fallback(c["n_c"], F.size(f["_values"])))

        def likelihoods(f):
            return F.transform(
                f["_values"],
                lambda v: F.struct(
                    v[VALUE],
                    F.transform(
                        "_cls",
                        lambda c: log_likelihood(
                            F.coalesce(F.try_element_at(v["_by_class"], c[LABEL]), F.lit(0).cast("bigint")),
                            c["n_c"],
                            F.size(f["_values"]),
                        ),
                    ),
                ),
            )

        inside = [int(i) for i in narrow]
        folded = F.filter("_features", lambda f: f[FEAT_IDX].isin(inside))
        return rows.select(
            *k,
            F.col("_cls")[LABEL].alias("classes"),
            F.transform("_cls", lambda c: log_prior(c["n_c"], total, F.size("_cls"))).alias("prior"),
            F.map_from_entries(
                F.transform(folded, lambda f: F.struct(f[FEAT_IDX], F.map_from_entries(likelihoods(f))))
            ).alias("lik"),
            F.map_from_entries(F.transform("_features", lambda f: F.struct(f[FEAT_IDX], fallbacks(f)))).alias("fallback"),
        )

    @cached_property
    def table(self) -> DataFrame:
        """All log-probabilities in one frame with a ``kind`` column."""
        k = self.keys
        prior = self.prior.select(
            *k,
            F.lit("prior").alias("kind"),
            F.lit(None).cast("int").alias(FEAT_IDX),
            F.lit(None).cast("string").alias(VALUE),
            LABEL,
            F.col("n_c").alias(N),
            F.col("log_prior").alias("log_prob"),
        )
        lik = self.likelihood.select(
            *k, F.lit("likelihood").alias("kind"), FEAT_IDX, VALUE, LABEL, N, F.col("log_lik").alias("log_prob")
        )
        fb = self.fallback.select(
            *k,
            F.lit("fallback").alias("kind"),
            FEAT_IDX,
            F.lit(None).cast("string").alias(VALUE),
            LABEL,
            F.lit(None).cast("bigint").alias(N),
            F.col("log_fallback").alias("log_prob"),
        )
        return prior.unionByName(lik).unionByName(fb)

    # -- driver-side scalars --------------------------------------------------
    def stats(self) -> ModelStats:
        """Model size figures, returned to the driver as a row per feature position.

        One pass over the distinct values and one over the class totals (a row
        per model and feature each), so nothing here is skewed or broadcast;
        every broadcast decision elsewhere is based on these.
        """
        if "_stats" not in self.__dict__:
            k = self.keys
            size = F.sum(F.lit(64) + F.coalesce(F.octet_length(VALUE), F.lit(0)) + F.octet_length(LABEL))
            small = (self.counts.agg(size.alias("s")).first()["s"] or 0) <= COLOCATE_MAX_BYTES
            counts = self.counts.coalesce(1) if small else self.counts
            values = counts.groupBy(*k, FEAT_IDX, VALUE).agg(F.lit(1).alias("one"))
            vocab = values.groupBy(*k, FEAT_IDX).agg(
                F.count(F.lit(1)).alias("n_values"), F.sum(F.octet_length(VALUE)).alias("bytes")
            )
            totals = _class_counts(counts, k).groupBy(*k).agg(
                F.count(F.lit(1)).alias("n_classes"), F.sum(F.octet_length(LABEL)).alias("label_bytes")
            )
            if small:
                # one partition: both meet as rows of a union, without the job that a broadcast is
                both = totals.unionByName(vocab, allowMissingColumns=True).coalesce(1)
                positions = F.collect_list(F.when(F.col("n_values").isNotNull(), F.struct(FEAT_IDX, "n_values", "bytes")))
                per = (
                    both.groupBy(*k)
                    .agg(F.max("n_classes").alias("n_classes"), F.max("label_bytes").alias("label_bytes"), positions.alias("p"))
                    .filter(F.col("n_classes").isNotNull())
                    .select("n_classes", "label_bytes", F.inline("p"))
                )
            else:
                per = vocab.join(totals, k)
            rows = (
                per.groupBy(FEAT_IDX)
                .agg(
                    F.count(F.lit(1)).alias("models"),
                    F.max("n_classes").alias("k"),
                    F.max("n_values").alias("mv"),
                    F.sum("n_values").alias("ne"),
                    F.sum(F.col("n_values") * F.col("n_classes")).alias("cells"),
                    F.sum("bytes").alias("bytes"),
                    F.sum("label_bytes").alias("label_bytes"),
                )
                .collect()  # a row per feature position
            )
            rows = [r for r in rows if r[FEAT_IDX] is not None]  # no features, no positions
            at = {r[FEAT_IDX]: r for r in rows}
            most = max(at, default=-1) + 1
            features = tuple(
                (at[i]["mv"], 8 * at[i]["cells"] + 64 * at[i]["ne"] + at[i]["bytes"]) if i in at else (0, 0) for i in range(most)
            )
            every = [r["models"] for r in rows]
            n_models = max(every, default=0)
            self.__dict__["_stats"] = ModelStats(
                n_models,
                max((r["k"] for r in rows), default=0),
                max((r["mv"] for r in rows), default=0),
                sum(r["ne"] for r in rows),
                sum(r["cells"] for r in rows),
                # positions that every model has
                sum(n == n_models for n in every),
                most,
                sum(r["bytes"] or 0 for r in rows),
                max((r["label_bytes"] or 0 for r in rows), default=0),
                features,
            )
        return self.__dict__["_stats"]

    def release(self) -> None:
        """Give up the durable counts (a checkpoint's files go when its frame does)."""
        release(self.counts)

    # -- persistence ----------------------------------------------------------
    def save(self, path: str, mode: str = "error") -> None:
        """Write the sufficient statistics; everything else is derived."""
        self.counts.write.mode(mode).parquet(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str, keys=(DATASET,)) -> "NBModel":
        return cls(spark.read.parquet(path), keys)


def train(prepared: DataFrame, keys=(DATASET,), durable: bool = True, weight: str | None = None) -> NBModel:
    """Fit a model per key from canonical rows; rows with a null label are ignored.

    ``weight`` names an optional integer multiplicity column (see
    ``count_features``).
    """
    counts = count_features(prepared, keys, weight)
    if durable:
        counts = make_durable(counts)
    return NBModel(counts, keys)
