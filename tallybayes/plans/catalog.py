"""Registered queries: each reads the driver tables under ``sf_dir``.

Every function takes ``(spark, sf_dir)`` and returns a DataFrame whose column
names match the DuckDB oracle in ``tallybayes.plans.oracle``. Doubles are
rounded to 9 places on both sides. No query caps, samples or sub-sets its
input; the only ``limit`` is the preview operator, where it is the feature.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybayes.operators.count_store import CountStore
from tallybayes.operators.evaluate import accuracy, accuracy_of_distinct, class_distribution, sample_rows, write_observed
from tallybayes.operators.owner import note, owning
from tallybayes.operators.predict import class_scores, predict
from tallybayes.operators.prepare import (
    DATASET,
    FEAT_IDX,
    FEATURES,
    LABEL,
    VALUE,
    fit_bins,
    hash_split,
    prepare,
    random_split,
    replicate,
    spread,
)
from tallybayes.operators.ranks import fit_mdl_bins, fit_quantile_bins, split_stratified
from tallybayes.operators.report import (
    DF_BASELINE,
    DF_OPTIMISED,
    RDD_BASELINE,
    RDD_OPTIMISED,
    accuracy_listing,
    complete_records,
    mean_by,
    mean_winner,
    pivot_table,
    size_label,
    speedups,
)
from tallybayes.operators.store import load_model, save_model
from tallybayes.operators.train import NBModel, long_form, shared_folder, stage_table, train
from tallybayes.sources.delimited import read_csv_table, read_text_table, read_with_rejects
from tallybayes.sources.spec import DatasetSpec
from tallybayes.sources.tables import (
    documents_labelled,
    documents_lang,
    events_set,
    lineitem_part,
    orders_set,
    read_table,
)

DIGITS = 9
EXPERIMENT_SCALES = (1, 10, 50)


def r9(c: str) -> F.Column:
    return F.round(F.col(c), DIGITS).alias(c)


def split_prepared(df: DataFrame, spec: DatasetSpec, stage: bool = False) -> tuple[DataFrame, DataFrame]:
    """(train, test) in canonical form, split by the id hash.

    ``stage=True`` prepares all rows once and stages the compact result
    (ids, label, feature array) as a Parquet table, so a wide source (long
    texts) is read once instead of once per split.
    """
    if stage:
        # the staged rows keep their ids, so the same split applies to them
        return hash_split(stage_table(prepare(df, spec), "prepared"), spec.ids)
    train_df, test_df = hash_split(df, spec.ids)
    return prepare(train_df, spec), prepare(test_df, spec)


def fit(df: DataFrame, spec: DatasetSpec, stage: bool = False) -> tuple[NBModel, DataFrame]:
    tr, te = split_prepared(df, spec, stage)
    return train(tr), te


def predictions(df: DataFrame, spec: DatasetSpec, scorer: str = "auto", stage: bool = False, **scoring) -> DataFrame:
    model, te = fit(df, spec, stage)
    out = predict(te, model, spec.ids, scorer=scorer, **scoring)
    return out.select(*spec.ids, LABEL, "prediction", r9("score"))


def accuracy_of(df: DataFrame, spec: DatasetSpec, scorer: str = "auto", stage: bool = False) -> DataFrame:
    model, te = fit(df, spec, stage)
    acc = accuracy(predict(te, model, spec.ids, scorer=scorer))
    return acc.select("n_test", "n_correct", r9("accuracy"))


# -- flagship: language of documents -----------------------------------------
# the features are six flags over long texts: stage the compact prepared rows
# so the text column is read once, not once per split
def nb_lang_predict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagship: language of held-out documents from six marker-word flags (M7)."""
    return predictions(*documents_lang(spark, sf_dir), stage=True)


def nb_lang_accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accuracy of the language classifier."""
    return accuracy_of(*documents_lang(spark, sf_dir), stage=True)


# -- other end-to-end predictions ---------------------------------------------
def nb_orders_predict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order priority from status, market segment and nation."""
    return predictions(*orders_set(spark, sf_dir))


def nb_orders_accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accuracy of the order-priority classifier."""
    return accuracy_of(*orders_set(spark, sf_dir))


def nb_lineitem_predict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Return flag from line status, line number, brand and type (M7)."""
    return predictions(*lineitem_part(spark, sf_dir))


def nb_lineitem_accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accuracy of the return-flag classifier."""
    return accuracy_of(*lineitem_part(spark, sf_dir))


def predict_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events scored with the join-based long scorer."""
    return predictions(*events_set(spark, sf_dir), scorer="long")


def nb_events_accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accuracy of the event-type classifier."""
    return accuracy_of(*events_set(spark, sf_dir))


def _quality_scored(spark: SparkSession, sf_dir: str, label: str = "quality") -> tuple[DataFrame, DatasetSpec]:
    """A document flag from language, source and a length bin fitted on training rows."""
    df, spec = documents_labelled(spark, sf_dir, label)
    # bins, training and test all read the joined rows: join once, stage the few columns
    df = stage_table(df.select(*spec.ids, spec.label, *spec.features), "labelled")
    tr, te = hash_split(df, spec.ids)
    edges = fit_bins(tr, ["n_chars"], bins=3)
    model = train(prepare(edges.apply(tr), spec))
    return predict(prepare(edges.apply(te), spec), model, spec.ids), spec


def nb_quality_predict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Document quality from language, source and a fitted length bin (M7, M9)."""
    pred, spec = _quality_scored(spark, sf_dir)
    return pred.select(*spec.ids, LABEL, "prediction", r9("score"))


def nb_quality_accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accuracy of the document-quality classifier."""
    pred, _ = _quality_scored(spark, sf_dir)
    return accuracy(pred).select("n_test", "n_correct", r9("accuracy"))


def nb_toxic_accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accuracy of the document-toxicity classifier."""
    pred, _ = _quality_scored(spark, sf_dir, "toxic")
    return accuracy(pred).select("n_test", "n_correct", r9("accuracy"))


# -- data preparation ---------------------------------------------------------
def class_distribution_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per order priority, most frequent first (A1, A5, O1)."""
    orders = read_table(spark, sf_dir, "orders")
    return class_distribution(orders, "o_orderpriority")


def label_feature_project(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Canonical label / feature projection of the orders set."""
    df, spec = orders_set(spark, sf_dir)
    p = prepare(df, spec)
    return p.select(
        "o_orderkey", LABEL, *[F.col(FEATURES)[i].alias(f"f{i}") for i in range(len(spec.features))]
    )


def wide_to_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per (line item, feature) in one Generate."""
    df, spec = lineitem_part(spark, sf_dir)
    return long_form(prepare(df, spec), keep=(*spec.ids, LABEL))


def hash_split_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows on each side of the md5 hash split of orders."""
    orders = read_table(spark, sf_dir, "orders")
    tr, te = hash_split(orders, ["o_orderkey"])
    return tr.select(F.lit("train").alias("part")).unionByName(te.select(F.lit("test").alias("part"))).groupBy(
        "part"
    ).agg(F.count(F.lit(1)).alias("n_rows"))


def random_split_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Training side of the seeded random split (R1; rows-only check)."""
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    tr, _ = random_split(orders)
    return tr


def random_split_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of orders, of both sides of the random split together, and in both at once."""
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    orders = stage_table(orders, "split-input")  # fixed before sampling
    tr, te = random_split(orders)
    sides = tr.withColumn("s", F.lit(1)).unionByName(te.withColumn("s", F.lit(2)))
    per = sides.groupBy("o_orderkey").agg(F.count_distinct("s").alias("sides"), F.count("*").alias("n"))
    found = per.agg(F.sum("n").alias("n_union"), F.sum(F.when(F.col("sides") > 1, 1).otherwise(0)).cast("bigint").alias("n_overlap"))
    rows = orders.agg(F.count("*").alias("n_rows"))
    return rows.crossJoin(found)  # one row each


def replicate_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class counts of the training rows replicated three times."""
    df, spec = orders_set(spark, sf_dir)
    tr, _ = split_prepared(df, spec)
    model = train(replicate(tr, 3).drop("copy"))
    return model.prior.select(LABEL, "n_c", r9("log_prior"))


def binned_train_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts over equal-width bins of quantity and discount fitted on training rows (M9)."""
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag", "l_quantity", "l_discount"
    )
    spec = DatasetSpec(
        "lineitem_bins", ("l_quantity", "l_discount"), "l_returnflag", ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    )
    tr, _ = hash_split(li, spec.ids)
    edges = fit_bins(tr, spec.features, bins=3)
    model = train(prepare(edges.apply(tr), spec))
    return model.counts.select(FEAT_IDX, VALUE, LABEL, "n")


def sample_rows_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First five orders by key: the ordered preview (K4)."""
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    return sample_rows(orders, 5, ["o_orderkey"])


# -- model internals (lineitem join part) -----------------------------------
def _lineitem_model(spark: SparkSession, sf_dir: str) -> tuple[NBModel, DatasetSpec]:
    df, spec = lineitem_part(spark, sf_dir)
    model, _ = fit(df, spec)
    return model, spec


def feature_value_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(feature, value, class) counts of the lineitem model (A2-A4, K1)."""
    model, _ = _lineitem_model(spark, sf_dir)
    return model.counts.select(FEAT_IDX, VALUE, LABEL, "n")


def vocabulary_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct training values per feature."""
    model, spec = _lineitem_model(spark, sf_dir)
    names = F.array(*[F.lit(f) for f in spec.features])
    return model.vocabulary.select(FEAT_IDX, F.get(names, F.col(FEAT_IDX)).alias("feature"), "n_values")


def training_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Training rows N and classes K."""
    model, _ = _lineitem_model(spark, sf_dir)
    return model.totals.select("n_total", "n_classes")


def log_prior_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Laplace log priors (M1)."""
    model, _ = _lineitem_model(spark, sf_dir)
    return model.prior.select(LABEL, "n_c", r9("log_prior"))


def log_likelihood_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Laplace log likelihoods of every stored count."""
    model, _ = _lineitem_model(spark, sf_dir)
    return model.likelihood.select(FEAT_IDX, VALUE, LABEL, "n", r9("log_lik"))


def log_fallback_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log likelihood of an unseen value per feature and class."""
    model, _ = _lineitem_model(spark, sf_dir)
    return model.fallback.select(FEAT_IDX, LABEL, r9("log_fallback"))


def model_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All log-probabilities of the orders model with a kind column."""
    model, _ = fit(*orders_set(spark, sf_dir))
    return model.table.select("kind", FEAT_IDX, VALUE, LABEL, "n", r9("log_prob"))


def composite_key_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts under their display keys ``feat_<i>_<value>_<class>`` / ``class_<class>``."""
    model, _ = fit(*orders_set(spark, sf_dir))
    feat = model.counts.select(
        F.concat_ws("_", F.lit("feat"), F.col(FEAT_IDX).cast("string"), VALUE, LABEL).alias("key"), "n"
    )
    cls = model.classes.select(F.concat(F.lit("class_"), F.col(LABEL)).alias("key"), F.col("n_c").alias("n"))
    return feat.unionByName(cls)


def class_scores_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score of every test order for every class (M5)."""
    df, spec = orders_set(spark, sf_dir)
    model, te = fit(df, spec)
    return class_scores(te, model, spec.ids).select(*spec.ids, LABEL, "class", r9("score"))


# -- semantics at the edges ----------------------------------------------------
def predict_unseen(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Train without one region's nations: their n_name values are unseen."""
    df, spec = orders_set(spark, sf_dir, with_region=True)
    tr, te = hash_split(df, spec.ids)
    model = train(prepare(tr.filter(F.col("r_name") != "ASIA"), spec))
    out = predict(prepare(te, spec), model, spec.ids)
    return out.select(*spec.ids, LABEL, "prediction", r9("score"))


def nulls_as_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predictions with a null feature scored as its own category (E5)."""
    df, spec = orders_set(spark, sf_dir)
    df = df.withColumn("o_orderstatus", F.expr("nullif(o_orderstatus, 'P')"))
    return predictions(df, spec)


def label_with_underscore(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predictions for labels containing underscores."""
    df, _ = orders_set(spark, sf_dir)
    df = df.withColumn("status_segment", F.concat_ws("_", "o_orderstatus", "c_mktsegment"))
    spec = DatasetSpec("orders_us", ("o_orderpriority", "n_name"), "status_segment", ("o_orderkey",))
    return predictions(df, spec)


def accuracy_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accuracy of an empty test set is 0.0."""
    df, spec = orders_set(spark, sf_dir)
    model, te = fit(df, spec)
    empty = te.filter(F.col("o_orderkey") < 0)
    return accuracy(predict(empty, model, spec.ids)).select("n_test", "n_correct", r9("accuracy"))


# -- scans of delimited files written from the tables --------------------------
def _scratch(spark: SparkSession) -> str:
    """A fresh folder on shared storage (see ``shared_folder``)."""
    return shared_folder(spark, "scan")


def csv_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders set written headerless, label last, and read back as CSV."""
    df, spec = orders_set(spark, sf_dir)
    cols = ("o_orderkey", *spec.features, spec.label)
    path = _scratch(spark)
    df.select(*[F.col(c).cast("string") for c in cols]).write.option("header", "false").csv(path)
    return read_csv_table(spark, path, cols).withColumn("o_orderkey", F.col("o_orderkey").cast("bigint"))


def text_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders set written as raw lines, label first, split line by line."""
    df, spec = orders_set(spark, sf_dir)
    cols = (spec.label, *spec.features, "o_orderkey")
    path = _scratch(spark)
    line = F.concat_ws(",", *[F.col(c).cast("string") for c in cols])
    df.select(line.alias("value")).write.text(path)
    return read_text_table(spark, path, cols, strict=True).withColumn(
        "o_orderkey", F.col("o_orderkey").cast("bigint")
    )


def scan_policies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders written as lines with outer blanks, empty fields and quoted commas, read by both scans."""
    df, _ = orders_set(spark, sf_dir)
    status = F.when(F.col("o_orderstatus") == "P", F.lit("")).otherwise(F.col("o_orderstatus"))
    quoted = F.concat(F.lit('"'), F.col("c_mktsegment"), F.lit(","), F.col("n_name"), F.lit('"'))
    line = F.concat_ws(",", F.concat(F.lit("  "), F.col("o_orderkey").cast("string")), status, quoted, F.concat("o_orderpriority", F.lit(" ")))
    path = _scratch(spark)
    df.select(line.alias("value")).write.text(path)
    cols = ("key", "status", "segment", "priority")
    csv = read_csv_table(spark, path, cols).select(F.lit("csv").alias("scan"), *cols, F.lit(None).cast("string").alias("rest"))
    text = read_text_table(spark, path, cols, rest="rest")
    return csv.unionByName(text.select(F.lit("text").alias("scan"), *cols, F.array_join("rest", ",").alias("rest")))


def predict_repeated_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders scored under the customer's key, which repeats: a prediction for every row."""
    df, spec = orders_set(spark, sf_dir, extra=("o_custkey",))
    tr, te = hash_split(df, spec.ids)
    model = train(prepare(tr, spec))
    by_customer = DatasetSpec(spec.name, spec.features, spec.label, ("o_custkey",))
    out = predict(prepare(te, by_customer), model, by_customer.ids, scorer="long")
    return out.select("o_custkey", LABEL, "prediction", r9("score"))


def predict_shuffle_tier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events scored with the model joined by shuffles, as one too large to broadcast would be."""
    df, spec = events_set(spark, sf_dir)
    model, te = fit(df, spec)
    out = predict(te, model, spec.ids, scorer="long", max_dense_bytes=0)
    return out.select(*spec.ids, LABEL, "prediction", r9("score"))


def predict_tie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order under two labels: both classes tie, and the lowest label must win."""
    df, spec = orders_set(spark, sf_dir)
    twice = df.withColumn("o_orderpriority", F.explode(F.array(F.lit("z late"), F.lit("a early"))))
    return predictions(twice, spec)


# -- streaming: the batch-trained model applied to a file stream ---------------
def stream_predict_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events test rows arriving as a file stream, scored by the broadcast model.

    The test split is written to a fresh folder on shared storage, read back
    as a stream (one file per micro-batch), scored and appended to a Parquet
    sink; the sink's rows are returned. Same predictions as the batch scorer.
    """
    from tallybayes.streaming.scoring import score_stream, write_predictions

    df, spec = events_set(spark, sf_dir)
    tr, te = hash_split(df, spec.ids)
    model = train(prepare(tr, spec))
    base = _scratch(spark)
    te.write.parquet(f"{base}/in")
    stream = spark.readStream.schema(te.schema).option("maxFilesPerTrigger", 1).parquet(f"{base}/in")
    query = write_predictions(score_stream(stream, spec, model), f"{base}/out", f"{base}/chk")
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    out = spark.read.parquet(f"{base}/out")
    return out.select(*spec.ids, LABEL, "prediction", r9("score"))


# -- experiment sweep: one model per (dataset, scale) in one job ---------------
def _experiment(spark: SparkSession, sf_dir: str, scales=EXPERIMENT_SCALES) -> tuple[NBModel, DataFrame]:
    """Models for every dataset and replication scale, trained in one job, and their test rows.

    Training rows replicated ``scale`` times are counted through a
    multiplicity column (``weight = scale``): the counts are exactly those of
    the replicated rows, but the data is read and exploded once, not
    ``sum(scales)`` times. Test rows are the base test split, scored once per
    scale's model.
    """
    parts = []
    for df, spec in (orders_set(spark, sf_dir), events_set(spark, sf_dir)):
        (rid,) = spec.ids
        renamed = df.withColumnRenamed(rid, "row_id")
        s = DatasetSpec(spec.name, spec.features, spec.label, ("row_id",))
        tr, te = hash_split(renamed, s.ids)
        parts.append((prepare(tr, s), prepare(te, s)))
    train_rows = parts[0][0].unionByName(parts[1][0])
    test_rows = parts[0][1].unionByName(parts[1][1])
    scale_col = F.explode(F.array(*[F.lit(int(s)) for s in scales]))
    train_rows = train_rows.withColumn("scale", scale_col)
    test_rows = test_rows.withColumn("scale", scale_col)
    return train(train_rows, keys=(DATASET, "scale"), weight="scale"), test_rows


def experiment_predictions(
    spark: SparkSession, sf_dir: str, scales=EXPERIMENT_SCALES, scorer: str = "auto"
) -> tuple[NBModel, DataFrame]:
    """The models of the experiment, and every test row scored by each model of its dataset."""
    model, test_rows = _experiment(spark, sf_dir, scales)
    return model, predict(test_rows, model, ["row_id"], scorer=scorer)


def _records(model: NBModel, test_rows: DataFrame, scorer: str) -> DataFrame:
    acc = accuracy(predict(test_rows, model, ["row_id"], scorer=scorer), by=(DATASET, "scale"))
    return acc.join(model.totals, [DATASET, "scale"]).select(
        DATASET,
        "scale",
        size_label(F.col("scale")).alias("size_label"),
        F.col("n_total").alias("n_train"),
        "n_test",
        "n_correct",
        r9("accuracy"),
    )


def experiment_records(spark: SparkSession, sf_dir: str, scorer: str = "auto") -> DataFrame:
    """Accuracy per dataset and scale, one model each, one job (B5, P11). Scales are multiplicities of counts."""
    return _records(*_experiment(spark, sf_dir), scorer)


def experiment_records_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same records with the long scorer: six models joined on (dataset, scale, feature, value)."""
    return experiment_records(spark, sf_dir, scorer="long")


def report_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dataset x size table of accuracy over the experiment records."""
    records = experiment_records(spark, sf_dir).withColumn("impl", F.lit("map"))
    return pivot_table(records, value="accuracy")


EXPERIMENT_IMPLS = ("long", "map", "map_arrays")


def _experiment_by_impl(spark: SparkSession, sf_dir: str) -> DataFrame:
    # one training for all scorers; the joined and exploded test rows are staged once, too
    model, test_rows = _experiment(spark, sf_dir)
    test_rows = stage_table(test_rows, "experiment")
    parts = [_records(model, test_rows, s).withColumn("impl", F.lit(s)) for s in EXPERIMENT_IMPLS]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def report_pivot_impl(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dataset and scorer x size table of accuracy."""
    return pivot_table(_experiment_by_impl(spark, sf_dir), value="accuracy")


def accuracy_listing_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accuracy by dataset, scorer and scale."""
    return accuracy_listing(_experiment_by_impl(spark, sf_dir))


# -- reports over run records derived from line items ---------------------------
def _run_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run records: the return flag is the dataset, the line number picks the implementation, the supplier the scale.

    Times are whole numbers of a line's quantity and price, summed, over 1000: the
    same in every engine and row order.
    """
    li = read_table(spark, sf_dir, "lineitem")
    impls = F.array(*[F.lit(x) for x in (RDD_BASELINE, RDD_OPTIMISED, DF_BASELINE, DF_OPTIMISED)])
    scales = F.array(*[F.lit(x) for x in (1, 10, 50, 100)])
    return li.groupBy(
        F.col("l_returnflag").alias("dataset"),
        F.element_at(impls, (F.col("l_linenumber") % 4 + 1).cast("int")).alias("impl"),
        F.element_at(scales, (F.col("l_suppkey") % 4 + 1).cast("int")).alias("scale"),
    ).agg(
        (F.sum(F.floor("l_quantity").cast("bigint")) / 1000).alias("train_time"),
        (F.sum(F.floor("l_extendedprice").cast("bigint")) / 1000).alias("pred_time"),
    )


def report_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Total time (train + predict) and size label of every run record."""
    rec = complete_records(_run_records(spark, sf_dir))
    return rec.select("dataset", "impl", "scale", "size_label", r9("train_time"), r9("pred_time"), r9("total_time"))


def report_total_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dataset and implementation x size table of total time, with a size that has no name."""
    out = pivot_table(_run_records(spark, sf_dir))
    return out.select("dataset", "impl", *[r9(c) for c in out.columns[2:]])


def report_speedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base / optimised ratios and the faster interface for each dataset and size."""
    out = speedups(_run_records(spark, sf_dir))
    return out.select("dataset", "size_label", r9("rdd_speedup"), r9("df_speedup"), "winner")


def report_mean_by(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean total time of each implementation (A10)."""
    out = mean_by(complete_records(_run_records(spark, sf_dir)))
    return out.select("impl", r9("mean_total_time"))


def report_mean_winner(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean total time of either interface over paired runs, and the faster one."""
    rec = complete_records(_run_records(spark, sf_dir))

    def best(base: str, opt: str) -> F.Column:
        return F.min(F.when(F.col("impl").isin(base, opt), F.col("total_time")))

    runs = rec.groupBy("dataset", "scale").agg(
        best(RDD_BASELINE, RDD_OPTIMISED).alias("rdd_total"), best(DF_BASELINE, DF_OPTIMISED).alias("df_total")
    )
    return mean_winner(runs).select(r9("avg_rdd"), r9("avg_df"), "winner")


# -- models of many classes, many values, many versions -------------------------
def _customer_set(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DatasetSpec]:
    """Orders labelled by their customer: a class for each."""
    df, _ = orders_set(spark, sf_dir, extra=("o_custkey",))
    spec = DatasetSpec("orders_customer", ("c_mktsegment", "n_name", "o_orderstatus", "o_orderpriority"), "o_custkey", ("o_orderkey",))
    return df, spec


def predict_many_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The customer of every held-out order: a class per customer, scored by posting lists (M5-M7).

    Many customers have the same counts in another order: their scores are ties.
    """
    return predictions(*_customer_set(spark, sf_dir), scorer="sparse", tie_digits=DIGITS)


def accuracy_many_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accuracy of the customer classifier over distinct vectors."""
    df, spec = _customer_set(spark, sf_dir)
    model, te = fit(df, spec)
    acc = accuracy_of_distinct(te, model, scorer="sparse", tie_digits=DIGITS)
    return acc.select("n_test", "n_correct", r9("accuracy"))


def accuracy_weighted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accuracy of the return-flag classifier, each distinct vector scored once."""
    df, spec = lineitem_part(spark, sf_dir)
    model, te = fit(df, spec)
    return accuracy_of_distinct(te, model).select("n_test", "n_correct", r9("accuracy"))


def _stored(spark: SparkSession, model: NBModel) -> NBModel:
    """The model saved to shared storage and loaded again."""
    path = shared_folder(spark, "model")
    save_model(model, path)
    model.release()
    loaded = load_model(spark, path)
    note(loaded)
    return loaded


def predict_size_safe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events scored from a stored model that is never broadcast: bucketed lookups and a salted header."""
    df, spec = events_set(spark, sf_dir)
    model, te = fit(df, spec)
    out = predict(te, _stored(spark, model), spec.ids, scorer="map", max_map_bytes=0, max_dense_bytes=0)
    return out.select(*spec.ids, LABEL, "prediction", r9("score"))


def model_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders scored by a model that was saved and loaded (M4)."""
    df, spec = orders_set(spark, sf_dir)
    model, te = fit(df, spec)
    return predict(te, _stored(spark, model), spec.ids).select(*spec.ids, LABEL, "prediction", r9("score"))


def counts_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of orders that arrive in four parts: one twice, one withdrawn and delivered again (A2-A4)."""
    df, spec = orders_set(spark, sf_dir)
    store = CountStore(spark, shared_folder(spark, "counts"))

    def part(i: int) -> DataFrame:
        return prepare(df.filter(F.pmod("o_orderkey", F.lit(4)) == i), spec)

    for i in (0, 1, 2, 1):
        store.add(f"part-{i}", part(i))
    store.snapshot()
    store.withdraw("part-2")
    for i in (3, 2):
        store.add(f"part-{i}", part(i))
    return store.counts().select(FEAT_IDX, VALUE, LABEL, "n")


def predict_observed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accuracy of the event-type classifier, counted by the job that writes the predictions."""
    df, spec = events_set(spark, sf_dir)
    model, te = fit(df, spec)
    out = write_observed(predict(te, model, spec.ids), shared_folder(spark, "predictions"))
    return out.select("n_test", "n_correct", r9("accuracy"))


def spread_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders dealt to seven partitions: partitions, rows, distinct keys, and whether none has much more than its share."""
    orders = spread(read_table(spark, sf_dir, "orders").select("o_orderkey"), 7)
    per = orders.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n"), F.sum("o_orderkey").alias("s"))
    return per.agg(
        F.count("*").alias("n_parts"), F.sum("n").alias("n_rows"), F.sum("s").alias("key_sum"), (F.max("n") <= 1.2 * F.avg("n")).alias("even")
    )


def split_stratified_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The side of every order in a split that is exact in each priority."""
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    tr, te = split_stratified(orders, "o_orderpriority", ["o_orderkey"])
    return tr.withColumn("part", F.lit("train")).unionByName(te.withColumn("part", F.lit("test")))


def _binned_counts(df: DataFrame, spec: DatasetSpec, fit_cuts) -> DataFrame:
    tr, _ = hash_split(df, spec.ids)
    cuts = fit_cuts(tr)
    return train(prepare(cuts.apply(tr), spec)).counts.select(FEAT_IDX, VALUE, LABEL, "n")


def binned_quantile_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts over bins between the exact quartiles of price and discount (M9)."""
    ids = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    li = read_table(spark, sf_dir, "lineitem").select(*ids, "l_returnflag", "l_extendedprice", "l_discount")
    spec = DatasetSpec("lineitem_quartiles", ("l_extendedprice", "l_discount"), "l_returnflag", ids)
    return _binned_counts(li, spec, lambda tr: fit_quantile_bins(tr, spec.features, bins=4))


def binned_mdl_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts over bins cut where unit price and discount tell tens of quantity apart (M9)."""
    ids = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    li = read_table(spark, sf_dir, "lineitem").select(
        *ids, (F.col("l_extendedprice") / F.col("l_quantity")).alias("unit_price"), "l_discount", F.floor(F.col("l_quantity") / 10).alias("tens")
    )
    spec = DatasetSpec("lineitem_mdl", ("unit_price", "l_discount"), "tens", ids)
    return _binned_counts(li, spec, lambda tr: fit_mdl_bins(tr, spec.features, "tens"))


def scan_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders written as lines, half of them spoilt in five ways: the rows that fit, and the others with the reason."""
    orders = read_table(spark, sf_dir, "orders")
    key = F.col("o_orderkey")
    line = F.concat_ws(",", key.cast("string"), "o_orderstatus", "o_orderpriority")
    spoilt = (
        F.when(key % 10 == 0, F.concat_ws(",", key.cast("string"), "o_orderstatus"))
        .when(key % 10 == 1, F.concat(line, F.lit(",more")))
        .when(key % 10 == 2, F.concat(F.lit("no"), line))
        .when(key % 10 == 3, F.lit("   "))
        .when(key % 10 == 4, F.concat(line, F.lit(',"open')))
        .otherwise(line)
    )
    path = _scratch(spark)
    orders.select(spoilt.alias("value")).write.text(path)
    found = read_with_rejects(spark, path, {"key": "bigint", "status": "string", "priority": "string"})
    none = F.lit(None).cast("string")
    good = found.accepted.select("key", "status", "priority", none.alias("line"), none.alias("reason"))
    return good.unionByName(found.rejects.select(F.lit(None).cast("bigint").alias("key"), none.alias("status"), none.alias("priority"), "line", "reason"))


def stream_sink_restart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events scored by a stream that is stopped between batches and started again: each row once (K2)."""
    from tallybayes.streaming.sink import OnceSink, write_predictions_once

    df, spec = events_set(spark, sf_dir)
    tr, te = hash_split(df, spec.ids)
    model = train(prepare(tr, spec))
    base = _scratch(spark)
    spread(te, 4).write.parquet(f"{base}/in")
    sink = OnceSink(spark, f"{base}/out")

    def start():
        stream = spark.readStream.schema(te.schema).option("maxFilesPerTrigger", 1).parquet(f"{base}/in")
        return write_predictions_once(stream, spec, model, sink.path, f"{base}/chk", lambda p: p.select(*spec.ids, LABEL, "prediction", r9("score")))

    query = start()
    while query.isActive and not sink.committed():
        query.awaitTermination(1)
    query.stop()
    query = start()
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    return sink.read()


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "nb_lang_predict": nb_lang_predict,
    "nb_lang_accuracy": nb_lang_accuracy,
    "nb_orders_predict": nb_orders_predict,
    "nb_orders_accuracy": nb_orders_accuracy,
    "nb_lineitem_predict": nb_lineitem_predict,
    "nb_lineitem_accuracy": nb_lineitem_accuracy,
    "nb_events_accuracy": nb_events_accuracy,
    "predict_long": predict_long,
    "nb_quality_predict": nb_quality_predict,
    "nb_quality_accuracy": nb_quality_accuracy,
    "nb_toxic_accuracy": nb_toxic_accuracy,
    "class_distribution": class_distribution_q,
    "label_feature_project": label_feature_project,
    "wide_to_long": wide_to_long,
    "composite_key_counts": composite_key_counts,
    "feature_value_counts": feature_value_counts,
    "vocabulary_size": vocabulary_size,
    "training_totals": training_totals,
    "log_prior": log_prior_q,
    "log_likelihood": log_likelihood_q,
    "log_fallback": log_fallback_q,
    "model_table": model_table,
    "class_scores": class_scores_q,
    "predict_unseen": predict_unseen,
    "nulls_as_category": nulls_as_category,
    "label_with_underscore": label_with_underscore,
    "accuracy_empty": accuracy_empty,
    "hash_split_counts": hash_split_counts,
    "random_split_rows": random_split_rows,
    "replicate_counts": replicate_counts,
    "binned_train_counts": binned_train_counts,
    "sample_rows": sample_rows_q,
    "stream_predict_events": stream_predict_events,
    "csv_scan": csv_scan,
    "text_scan": text_scan,
    "scan_policies": scan_policies,
    "random_split_check": random_split_check,
    "predict_repeated_ids": predict_repeated_ids,
    "predict_shuffle_tier": predict_shuffle_tier,
    "predict_tie": predict_tie,
    "experiment_records": experiment_records,
    "experiment_records_long": experiment_records_long,
    "report_pivot": report_pivot,
    "report_pivot_impl": report_pivot_impl,
    "accuracy_listing": accuracy_listing_q,
    "report_totals": report_totals,
    "report_total_pivot": report_total_pivot,
    "report_speedup": report_speedup,
    "report_mean_by": report_mean_by,
    "report_mean_winner": report_mean_winner,
    "predict_many_classes": predict_many_classes,
    "accuracy_many_classes": accuracy_many_classes,
    "predict_size_safe": predict_size_safe,
    "counts_incremental": counts_incremental,
    "binned_quantile_counts": binned_quantile_counts,
    "binned_mdl_counts": binned_mdl_counts,
    "accuracy_weighted": accuracy_weighted,
    "split_stratified": split_stratified_q,
    "model_roundtrip": model_roundtrip,
    "predict_observed": predict_observed,
    "stream_sink_restart": stream_sink_restart,
    "scan_rejects": scan_rejects,
    "spread_rows": spread_rows,
}
# a result owns what was staged for it until it is released
QUERIES = {name: owning(query) for name, query in QUERIES.items()}
