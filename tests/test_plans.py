"""Physical plan shape: one scan, partial aggregation, no shuffle when scoring."""

from __future__ import annotations

import contextlib
import io
import re

from tallybayes import predict, train
from tallybayes.operators.train import count_features
from tallybayes.plans.catalog import experiment_predictions, split_prepared
from tallybayes.sources import documents_lang, lineitem_part

SF = "/root/testdata/sf0.001"
PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "PythonUDF", "MapInPandas", "FlatMapGroupsInPandas")


def plan_text(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


def ancestors(text: str, pattern: str) -> list[str]:
    """Operator names on the path from the first line matching ``pattern`` to the root."""
    lines = [ln for ln in text.splitlines() if ln.strip() and not ln.startswith("==")]

    def depth(ln: str) -> int:
        m = re.search(r"[+:]-", ln)
        return m.start() if m else 0

    idx = next(i for i, ln in enumerate(lines) if re.search(pattern, ln))
    out, d = [], depth(lines[idx])
    for ln in reversed(lines[:idx]):
        if depth(ln) < d:
            out.append(ln.strip(" +-:"))
            d = depth(ln)
    return out


def test_training_is_one_scan_and_one_partial_aggregate(spark):
    df, spec = documents_lang(spark, SF)
    tr, _ = split_prepared(df, spec)
    text = plan_text(count_features(tr))
    assert text.count("FileScan") == 1
    assert text.count("Exchange") == 1
    assert "partial_count" in text
    assert "CartesianProduct" not in text
    assert not any(p in text for p in PYTHON_NODES)
    # the scan reads only the three needed columns and the split predicate is pushed into it
    assert re.search(r"ReadSchema: struct<doc_id:bigint,text:string,lang:string>", text)


def test_map_scorer_never_shuffles_the_test_rows(spark):
    df, spec = lineitem_part(spark, SF)
    tr, te = split_prepared(df, spec)
    model = train(tr)
    text = plan_text(predict(te, model, spec.ids, scorer="map"))
    assert "Broadcast" in text
    assert not any(p in text for p in PYTHON_NODES)
    assert "CartesianProduct" not in text
    up = ancestors(text, r"FileScan parquet .*lineitem")
    assert not any(a.startswith("Exchange") for a in up), up
    assert not any(a.startswith("SortMergeJoin") for a in up), up


def test_wide_features_need_no_shuffle_of_the_test_rows(spark):
    df, spec = lineitem_part(spark, SF)
    tr, te = split_prepared(df, spec)
    text = plan_text(predict(te, train(tr), spec.ids, scorer="map", max_map_values=5))
    up = ancestors(text, r"FileScan parquet .*lineitem")
    assert sum(a.startswith("BroadcastHashJoin") for a in up) >= 3, up
    assert not any(a.startswith(("Exchange", "SortMergeJoin")) for a in up), up


def test_grouped_models_join_on_their_key(spark):
    _, pred = experiment_predictions(spark, SF, scales=(1, 2))
    text = plan_text(pred)
    assert "BroadcastHashJoin [dataset" in text
    assert not any(p in text for p in PYTHON_NODES)


def test_long_scorer_plan_has_no_python(spark):
    df, spec = lineitem_part(spark, SF)
    tr, te = split_prepared(df, spec)
    text = plan_text(predict(te, train(tr), spec.ids, scorer="long"))
    assert not any(p in text for p in PYTHON_NODES)
    assert "CartesianProduct" not in text
    # with one constant model key Catalyst folds the key join into a nested-loop
    # join whose broadcast build side is the one-row model header
    for ln in text.splitlines():
        if "BroadcastNestedLoopJoin" in ln:
            assert "BuildRight" in ln
    # numbered test rows are read back from their checkpoint and regrouped by number
    assert "hashpartitioning(_row" in text and re.search("(SortMerge|BroadcastHash)Join", text)


def test_unrolled_map_scorer_stays_in_whole_stage_codegen(spark):
    df, spec = lineitem_part(spark, SF)
    tr, te = split_prepared(df, spec)
    pred = predict(te, train(tr), spec.ids, scorer="map")
    pred.collect()  # with AQE, codegen stage markers appear in the final plan
    text = plan_text(pred).split("== Initial Plan ==")[0]
    proj = [ln for ln in text.splitlines() if "Project" in ln and "greatest" in ln]
    assert proj and all(re.search(r"\*\(\d+\) Project", ln) for ln in proj), proj
    assert "lambdafunction" not in text.split("BroadcastExchange")[0]


def test_no_shuffle_join_on_the_model_key_alone(spark, monkeypatch):
    """Small models: co-partitioned joins; larger ones: broadcast dimension joins."""
    import importlib

    T = importlib.import_module("tallybayes.operators.train")
    df, spec = lineitem_part(spark, SF)
    tr, te = split_prepared(df, spec)
    model = train(tr)
    for scorer in ("map", "long"):
        pred = predict(te, model, spec.ids, scorer=scorer)
        pred.collect()
        text = plan_text(pred).split("== Initial Plan ==")[0]
        # the only exchange on the model key alone is the stats-bounded repartition
        assert not re.search(r"Exchange hashpartitioning\(dataset#\d+, \d+\), ENSURE_REQUIREMENTS", text)
    monkeypatch.setattr(T, "COLOCATE_MAX_BYTES", -1)
    big = T.NBModel(model.counts, model.keys)
    for scorer in ("map", "long"):
        pred = predict(te, big, spec.ids, scorer=scorer)
        pred.collect()
        text = plan_text(pred).split("== Initial Plan ==")[0]
        for ln in text.splitlines():
            m = re.search(r"SortMergeJoin \[([^\]]*)\]", ln)
            if m:
                keys = [k.split("#")[0] for k in m.group(1).split(", ")]
                assert keys != ["dataset"] and keys != ["dataset", "label"], ln


def test_long_scorer_shuffle_tier_splits_hot_values(spark):
    """Beyond every broadcast bound, hot (feature, value) keys are split by AQE."""
    from tallybayes import accuracy

    confs = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
    }
    old = {k: spark.conf.get(k, None) for k in confs}
    try:
        for k, v in confs.items():
            spark.conf.set(k, v)
        df, spec = lineitem_part(spark, "/root/testdata/sf0.1")
        tr, te = split_prepared(df, spec)
        model = train(tr)
        pred = predict(te, model, spec.ids, scorer="long", max_dense_bytes=0)
        rows = sorted(tuple(r) for r in pred.collect())
        text = plan_text(pred).split("== Initial Plan ==")[0]
        assert "SortMergeJoin(skew=true)" in text, [ln for ln in text.splitlines() if "Join" in ln]
        want = sorted(tuple(r) for r in predict(te, model, spec.ids, scorer="map").collect())
        assert rows == want
        assert accuracy(pred).first().n_test == len(rows)
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
