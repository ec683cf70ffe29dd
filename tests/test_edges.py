"""Edge semantics: ties, unseen values, underscores, nulls, empty inputs."""

from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from tallybayes import DatasetSpec, accuracy, class_scores, predict, prepare, train
from tallybayes.functions import UNKNOWN_LOG_PROB

SPEC = DatasetSpec("edge", ("f0",), "label", ("id",))
DDL = "id int, label string, f0 string"


def frame(spark, rows, ddl=DDL):
    return spark.createDataFrame(rows, ddl)


@pytest.mark.parametrize("scorer", ["map", "map_arrays", "long"])
def test_tie_goes_to_lowest_label_and_unseen_uses_fallback(spark, scorer):
    m = train(prepare(frame(spark, [(1, "z", "u"), (2, "a", "u")]), SPEC))
    test = prepare(frame(spark, [(10, "a", "u"), (11, "z", "new")]), SPEC)
    out = {r.id: r for r in predict(test, m, ["id"], scorer=scorer).collect()}
    assert out[10].prediction == "a" and out[11].prediction == "a"
    # prior ln(2/4); seen value ln(2/2); unseen value ln(1/2)
    assert out[10].score == pytest.approx(math.log(0.5), abs=1e-12)
    assert out[11].score == pytest.approx(math.log(0.25), abs=1e-12)


@pytest.mark.parametrize("scorer", ["map", "map_arrays", "long"])
def test_underscore_labels_and_values_do_not_collide(spark, scorer):
    rows = [(1, "very_good", "a_b"), (2, "very_good", "a_b"), (3, "good", "a"), (4, "bad", "b_c")]
    m = train(prepare(frame(spark, rows), SPEC))
    classes = sorted(r.label for r in m.classes.collect())
    assert classes == ["bad", "good", "very_good"]
    counts = {(r.value, r.label): r.n for r in m.counts.collect()}
    assert counts == {("a_b", "very_good"): 2, ("a", "good"): 1, ("b_c", "bad"): 1}
    assert all(r.log_lik <= 0 for r in m.likelihood.collect())
    pred = predict(prepare(frame(spark, rows), SPEC), m, ["id"], scorer=scorer)
    assert {r.id: r.prediction for r in pred.collect()} == {1: "very_good", 2: "very_good", 3: "good", 4: "bad"}


@pytest.mark.parametrize("scorer", ["map", "map_arrays", "long"])
def test_null_feature_is_its_own_category(spark, scorer):
    rows = [(1, "x", None), (2, "x", None), (3, "y", "v"), (4, "y", "v")]
    m = train(prepare(frame(spark, rows), SPEC))
    assert sorted(r.value for r in m.counts.collect()) == ["None", "v"]
    test = prepare(frame(spark, [(5, "x", None), (6, "y", "v")]), SPEC)
    assert {r.id: r.prediction for r in predict(test, m, ["id"], scorer=scorer).collect()} == {5: "x", 6: "y"}


def test_null_labels_are_dropped_from_training(spark):
    rows = [(1, None, "u"), (2, "a", "u")]
    m = train(prepare(frame(spark, rows), SPEC))
    assert [(r.label, r.n_c) for r in m.classes.collect()] == [("a", 1)]


def test_empty_test_set_accuracy_is_zero(spark):
    m = train(prepare(frame(spark, [(1, "a", "u")]), SPEC))
    empty = prepare(frame(spark, []), SPEC)
    r = accuracy(predict(empty, m, ["id"])).first()
    assert (r.n_test, r.n_correct, r.accuracy) == (0, 0, 0.0)


@pytest.mark.parametrize("scorer", ["map", "map_arrays", "long"])
def test_empty_training_keeps_rows_with_null_prediction(spark, scorer):
    m = train(prepare(frame(spark, []), SPEC))
    test = prepare(frame(spark, [(1, "a", "u"), (2, "b", "v")]), SPEC)
    out = predict(test, m, ["id"], scorer=scorer).collect()
    assert len(out) == 2 and all(r.prediction is None for r in out)
    assert accuracy(predict(test, m, ["id"], scorer=scorer)).first().accuracy == 0.0


def test_class_only_in_test_counts_as_wrong(spark):
    m = train(prepare(frame(spark, [(1, "a", "u"), (2, "b", "v")]), SPEC))
    test = prepare(frame(spark, [(3, "a", "u"), (4, "c", "u")]), SPEC)
    r = accuracy(predict(test, m, ["id"])).first()
    assert (r.n_test, r.n_correct) == (2, 1) and r.accuracy == 0.5


def test_unknown_feature_index_uses_tiny_probability(spark):
    # a test row with more features than the model knows: extra feature gets ln(1e-10)
    m = train(prepare(frame(spark, [(1, "a", "u")]), SPEC))
    wide = DatasetSpec("edge", ("f0", "f1"), "label", ("id",))
    test = prepare(spark.createDataFrame([(2, "a", "u", "w")], "id int, label string, f0 string, f1 string"), wide)
    for scorer in ("map", "map_arrays", "long"):
        s = {r["class"]: r.score for r in class_scores(test, m, ["id"], scorer=scorer).collect()}
        # prior ln((1+1)/(1+1)) = 0; f0 seen ln(2/2) = 0; f1 unknown
        assert s["a"] == pytest.approx(UNKNOWN_LOG_PROB, abs=1e-12)


def test_map_and_long_scorers_agree_bit_for_bit(spark):
    from tallybayes.sources import orders_set
    from tallybayes.plans.catalog import split_prepared

    df, spec = orders_set(spark, "/root/testdata/sf0.001")
    tr, te = split_prepared(df, spec)
    m = train(tr)
    a = {tuple(r[:3]): r.score for r in class_scores(te, m, spec.ids, scorer="map").select("o_orderkey", "label", "class", "score").collect()}
    b = {tuple(r[:3]): r.score for r in class_scores(te, m, spec.ids, scorer="long").select("o_orderkey", "label", "class", "score").collect()}
    c = {tuple(r[:3]): r.score for r in class_scores(te, m, spec.ids, scorer="map_arrays").select("o_orderkey", "label", "class", "score").collect()}
    assert a == b == c and len(a) > 0
    pa = sorted(tuple(r) for r in predict(te, m, spec.ids, scorer="map").collect())
    pb = sorted(tuple(r) for r in predict(te, m, spec.ids, scorer="map_arrays").collect())
    assert pa == pb


def scorer_rows(spark, n_values=40, extra=10):
    """Training rows with a wide and a narrow feature; test rows with repeated, null and absent ids and extra features."""
    ddl = "id int, label string, f0 string, f1 string"
    tr = [(i, "abc"[i % 3], f"v{i * 7 % n_values}", "xy"[i % 2]) for i in range(120)]
    te = [(i % 5 if i % 4 else None, "abc"[i % 3], f"v{i * 11 % (n_values + 9)}", "xyz"[i % 3]) for i in range(60)]
    spec = DatasetSpec("edge", ("f0", "f1"), "label", ("id",))
    model = train(prepare(spark.createDataFrame(tr, ddl), spec))
    test = prepare(spark.createDataFrame(te, ddl), spec)
    return model, test, test.withColumn("features", F.concat("features", F.array_repeat(F.lit("x"), extra)))


ALL_SCORERS = [
    {"scorer": "map"},
    {"scorer": "map_arrays"},
    {"scorer": "long"},
    {"scorer": "long", "max_dense_bytes": 0},
    {"scorer": "map", "max_map_values": 5},
    {"scorer": "map_arrays", "max_map_values": 1},
    {"scorer": "map", "max_map_bytes": 1},
    {"scorer": "auto", "max_map_bytes": 1},
]


def test_all_scorers_agree_on_repeated_and_null_ids_and_extra_features(spark):
    from collections import Counter

    model, plain, many = scorer_rows(spark)
    for test in (plain, many):
        for ids in (["id"], []):
            want = Counter(map(tuple, predict(test, model, ids, **ALL_SCORERS[0]).collect()))
            assert sum(want.values()) == 60
            classes = Counter(map(tuple, class_scores(test, model, ids, **ALL_SCORERS[0]).collect()))
            for kw in ALL_SCORERS[1:]:
                assert Counter(map(tuple, predict(test, model, ids, **kw).collect())) == want, kw
                assert Counter(map(tuple, class_scores(test, model, ids, **kw).collect())) == classes, kw


def test_zero_weight_leaves_nothing_behind(spark):
    rows = spark.createDataFrame([(1, "a", "u", 2), (2, "b", "v", 0), (3, "c", "w", -1)], DDL + ", w int")
    prepared = prepare(rows, SPEC).withColumn("w", F.lit(0))
    assert train(prepared, weight="w").counts.count() == 0


def test_long_values_and_labels_count_towards_the_sizes(spark):
    rows = [(i, "l" * 1000, str(i) * 5000) for i in range(20)]
    st = train(prepare(frame(spark, rows), SPEC)).stats()
    assert st.dense_bytes > 20 * 5000 and st.header_bytes >= 1000 and st.features[0][1] > 20 * 5000


def test_many_models_and_many_classes_give_results(spark, monkeypatch):
    import importlib

    rows = [(i, f"c{i}", f"v{i % 50}") for i in range(400)]  # a near-unique label
    m = train(prepare(frame(spark, rows), SPEC))
    assert m.fallback.count() == 400 and m.table.count() == 400 + 400 + 400
    test = prepare(frame(spark, rows[:5]), SPEC)
    want = sorted(map(tuple, predict(test, m, ["id"], scorer="map").collect()))
    assert sorted(map(tuple, predict(test, m, ["id"], scorer="long").collect())) == want
    # no part may be broadcast: as for models of any size
    P = importlib.import_module("tallybayes.operators.predict")
    T = importlib.import_module("tallybayes.operators.train")
    monkeypatch.setattr(P, "MAX_DENSE_BROADCAST_BYTES", 0)
    for name in ("COLOCATE_MAX_BYTES", "MAX_DIM_BROADCAST_BYTES"):
        monkeypatch.setattr(T, name, 0)
    m2 = T.NBModel(m.counts, m.keys)
    for scorer in ("auto", "map", "long"):
        assert sorted(map(tuple, predict(test, m2, ["id"], scorer=scorer, max_map_bytes=1).collect())) == want
    keyed = prepare(frame(spark, rows), SPEC, keys={"dataset": F.col("f0")})
    many = train(keyed)
    assert many.stats().n_models == 50 and predict(keyed, many, ["id"]).count() == 400


def test_long_scorer_without_broadcast_matches(spark, monkeypatch):
    import importlib

    from tallybayes.plans.catalog import split_prepared
    from tallybayes.sources import events_set

    P = importlib.import_module("tallybayes.operators.predict")
    df, spec = events_set(spark, "/root/testdata/sf0.001")
    tr, te = split_prepared(df, spec)
    m = train(tr)
    want = sorted(tuple(r) for r in predict(te, m, spec.ids, scorer="map").collect())
    monkeypatch.setattr(P, "MAX_DENSE_BROADCAST_BYTES", 0)
    got = sorted(tuple(r) for r in predict(te, m, spec.ids, scorer="long").collect())
    assert got == want and len(got) > 0
    monkeypatch.setattr(P, "UNROLL_MAX_TERMS", 0)
    got2 = sorted(tuple(r) for r in predict(te, m, spec.ids, scorer="long").collect())
    assert got2 == want


@pytest.mark.parametrize("colocate,dim_bytes", [(-1, 256 * 1024 * 1024), (-1, 0), (64 * 1024 * 1024, 0)])
def test_model_derivation_modes_give_same_model(spark, monkeypatch, colocate, dim_bytes):
    """Co-located, broadcast-dimension and plain-shuffle derivations agree."""
    import importlib

    from tallybayes.plans.catalog import split_prepared
    from tallybayes.sources import orders_set

    T = importlib.import_module("tallybayes.operators.train")
    df, spec = orders_set(spark, "/root/testdata/sf0.001")
    tr, te = split_prepared(df, spec)
    m = train(tr)
    want_lik = sorted(tuple(r) for r in m.likelihood.collect())
    want = sorted(tuple(r) for r in predict(te, m, spec.ids, scorer="long").collect())
    monkeypatch.setattr(T, "COLOCATE_MAX_BYTES", colocate)
    monkeypatch.setattr(T, "MAX_DIM_BROADCAST_BYTES", dim_bytes)
    m2 = T.NBModel(m.counts, m.keys)
    assert sorted(tuple(r) for r in m2.likelihood.collect()) == want_lik
    assert sorted(tuple(r) for r in predict(te, m2, spec.ids, scorer="long").collect()) == want
    assert sorted(tuple(r) for r in predict(te, m2, spec.ids, scorer="map").collect()) == want


@pytest.mark.parametrize("scorer", ["map", "map_arrays", "long"])
def test_models_with_different_arity_in_one_job(spark, scorer):
    one = DatasetSpec("one", ("f0",), "label", ("id",))
    two = DatasetSpec("two", ("f0", "f1"), "label", ("id",))
    d1 = spark.createDataFrame([(1, "a", "u"), (2, "b", "v"), (3, "a", "v")], "id int, label string, f0 string")
    d2 = spark.createDataFrame(
        [(1, "x", "u", "p"), (2, "y", "u", "q"), (3, "y", "w", "q"), (4, "x", "w", "p")],
        "id int, label string, f0 string, f1 string",
    )
    p1, p2 = prepare(d1, one), prepare(d2, two)
    together = train(p1.unionByName(p2))
    got = {(r.dataset, r.id): (r.prediction, r.score) for r in predict(p1.unionByName(p2), together, ["id"], scorer=scorer).collect()}
    want = {}
    for p in (p1, p2):
        for r in predict(p, train(p), ["id"], scorer=scorer).collect():
            want[(r.dataset, r.id)] = (r.prediction, r.score)
    assert got == want and len(got) == 7
    assert together.stats().min_features == 1 and together.stats().max_features == 2
