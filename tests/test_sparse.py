"""The class-sparse scorer equals the dense ones, and no part of its plan is as long as the classes."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F
from test_plans import plan_text

from tallybayes import DatasetSpec, accuracy, accuracy_of_distinct, hash_split, predict, prepare, train
from tallybayes.operators import sparse
from tallybayes.operators.predict import choose_scorer
from tallybayes.sources import orders_set

SF = "/root/testdata/sf0.001"


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


def random_rows(rng, classes, rows, values, m):
    out = []
    for i in range(rows):
        label = f"c{min(rng.randrange(classes), rng.randrange(classes))}"
        # values that lean on the class, so that counts differ
        f = [f"v{(hash(label) % 7 + rng.randrange(values)) % values if rng.random() < 0.7 else rng.randrange(values + 2)}" for _ in range(m)]
        out.append(("d", i, label, f))
    return out


@pytest.mark.parametrize(("classes", "values", "m"), [(1, 2, 1), (5, 3, 2), (60, 8, 3)])
def test_equal_to_the_dense_scorers(spark, classes, values, m):
    rng = random.Random(classes * 100 + values)
    schema = "dataset string, id int, label string, features array<string>"
    train_rows = spark.createDataFrame(random_rows(rng, classes, 500, values, m), schema)
    test = random_rows(rng, classes, 150, values + 3, m)
    # fewer and more features than the model has, none at all, equal rows, another model, no model key
    test += [("d", 900, "c0", []), ("d", 901, "c1", ["v0"]), ("d", 902, None, ["v0"] * (m + 2)), test[0], test[0], ("e", 903, "c0", ["v0"] * m)]
    test += [("d", 904, "c0", ["never"] * m), (None, 905, "c0", ["v0"] * m), ("d", 906, "c0", ["never"] * (m + 1))]
    test = spark.createDataFrame(test, schema)
    model = train(train_rows)
    want = rows_of(predict(test, model, ["id"], scorer="long"))
    assert rows_of(predict(test, model, ["id"], scorer="map_arrays")) == want
    assert rows_of(predict(test, model, ["id"], scorer="sparse")) == want
    rounded = rows_of(predict(test, model, ["id"], scorer="map", tie_digits=6))
    assert rows_of(predict(test, model, ["id"], scorer="sparse", tie_digits=6)) == rounded
    assert rows_of(predict(test, model, ["id"], scorer="map_arrays", tie_digits=6)) == rounded


def test_several_models_at_once(spark):
    rng = random.Random(5)
    schema = "dataset string, id int, label string, features array<string>"
    a, b = random_rows(rng, 30, 300, 5, 3), [("e", *r[1:3], r[3][:2]) for r in random_rows(rng, 8, 200, 3, 3)]
    model = train(spark.createDataFrame(a + b, schema))
    test = spark.createDataFrame(random_rows(rng, 30, 60, 6, 3) + [("e", *r[1:]) for r in random_rows(rng, 8, 60, 4, 3)], schema)
    assert rows_of(predict(test, model, ["id"], scorer="sparse")) == rows_of(predict(test, model, ["id"], scorer="long"))


def test_classes_that_cannot_win_are_not_scored(spark, monkeypatch):
    df, _ = orders_set(spark, SF, extra=("o_custkey",))
    spec = DatasetSpec("orders_customer", ("c_mktsegment", "n_name", "o_orderstatus", "o_orderpriority"), "o_custkey", ("o_orderkey",))
    tr, te = hash_split(df, spec.ids)
    model, te = train(prepare(tr, spec)), prepare(te, spec)
    scored = []
    own = sparse.SparseModel.scored

    def counting(self, pairs, long):
        scored.append(pairs.count())
        return own(self, pairs, long)

    monkeypatch.setattr(sparse.SparseModel, "scored", counting)
    want = rows_of(predict(te, model, spec.ids, scorer="long"))
    assert rows_of(predict(te, model, spec.ids, scorer="sparse")) == want
    every = te.select("features").distinct().count() * model.stats().max_classes
    assert sum(scored) < 0.25 * every, (scored, every)


def test_chosen_for_many_classes_and_without_long_arrays(spark):
    rows = [("d", i, f"c{i % 1100}", [f"a{i % 3}", f"b{i % 50}"]) for i in range(3300)]
    df = spark.createDataFrame(rows, "dataset string, id int, label string, features array<string>")
    model = train(df)
    assert choose_scorer(model) == "sparse"
    text = plan_text(predict(df, model, ["id"]))
    assert "collect_list(struct(label" not in text and "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_accuracy_of_distinct_vectors(spark):
    df, spec = orders_set(spark, SF)
    tr, te = hash_split(df, spec.ids)
    model, te = train(prepare(tr, spec)), prepare(te, spec)
    want = accuracy(predict(te, model, spec.ids)).collect()
    assert accuracy_of_distinct(te, model).collect() == want
    assert accuracy_of_distinct(te, model, scorer="sparse").collect() == want
    none = accuracy_of_distinct(te.limit(0), model).first()
    assert tuple(none) == (0, 0, 0.0)
    # the scan's stage aggregates before the exchange
    text = plan_text(accuracy_of_distinct(te, model))
    assert text.index("Exchange hashpartitioning") < text.index("partial_count")


def test_null_feature_arrays(spark):
    schema = "dataset string, id int, label string, features array<string>"
    model = train(spark.createDataFrame([("d", 1, "x", ["a"]), ("d", 2, "y", ["b"])], schema))
    test = spark.createDataFrame([("d", 1, "x", None), ("d", 2, "x", ["b"])], schema)
    got = {r["id"]: r["prediction"] for r in predict(test, model, ["id"], scorer="sparse").collect()}
    assert got == {1: None, 2: "y"}
    assert predict(test.filter(F.lit(False)), model, ["id"], scorer="sparse").count() == 0


def test_pairs_are_not_kept_and_wide_classes_are_joined(spark, monkeypatch):
    rng = random.Random(11)
    schema = "dataset string, id int, label string, features array<string>"
    model = train(spark.createDataFrame(random_rows(rng, 200, 3000, 4, 3), schema))
    test = spark.createDataFrame(random_rows(rng, 200, 400, 5, 3), schema)
    want = rows_of(predict(test, model, ["id"], scorer="long"))
    staged, own = [], sparse.stage_table

    def counting(df, *name):
        out = own(df, *name)
        staged.append(out.count())
        return out

    monkeypatch.setattr(sparse, "stage_table", counting)
    assert rows_of(predict(test, model, ["id"], scorer="sparse")) == want
    # no table of a row per vector and class: a row per class and group of vectors is the longest
    assert max(staged) <= 200 * 4, staged
    monkeypatch.setattr(sparse, "MAX_PROFILE", 2)
    assert not sparse.SparseModel(model).narrow
    assert rows_of(predict(test, model, ["id"], scorer="sparse")) == want
