"""The two inline datasets, all rows as training and as test (FIXTURES.md)."""

from __future__ import annotations

import pytest

from tallybayes import accuracy, class_scores, predict, prepare, train
from tallybayes.sources import CAR_SPEC, MUSHROOM_SPEC, car_table, mushroom_table

CAR_SCORES = {
    1: ("unacc", {"acc": -2.590267, "good": -3.871201, "unacc": -2.184802}, "unacc"),
    2: ("unacc", {"acc": -3.283414, "good": -3.178054, "unacc": -2.184802}, "unacc"),
    3: ("acc", {"acc": -2.590267, "good": -3.871201, "unacc": -2.877949}, "acc"),
    4: ("acc", {"acc": -2.590267, "good": -3.178054, "unacc": -3.283414}, "acc"),
    5: ("good", {"acc": -3.283414, "good": -2.484907, "unacc": -3.283414}, "good"),
}
MUSHROOM_SCORES = {
    1: ("p", {"e": -15.458219, "p": -7.348460}, "p"),
    2: ("e", {"e": -8.696646, "p": -14.633280}, "e"),
    3: ("e", {"e": -9.913041, "p": -15.038746}, "e"),
    4: ("p", {"e": -16.556831, "p": -7.348460}, "p"),
    5: ("e", {"e": -11.129437, "p": -17.929117}, "e"),
}


@pytest.fixture(scope="module")
def car(spark):
    p = prepare(car_table(spark), CAR_SPEC)
    return p, train(p)


@pytest.fixture(scope="module")
def mushroom(spark):
    p = prepare(mushroom_table(spark), MUSHROOM_SPEC)
    return p, train(p)


def test_car_priors_and_vocabulary(car):
    _, m = car
    prior = {r.label: (r.n_c, r.log_prior) for r in m.prior.collect()}
    assert {k: v[0] for k, v in prior.items()} == {"unacc": 2, "acc": 2, "good": 1}
    assert prior["unacc"][1] == pytest.approx(-0.980829, abs=1e-6)
    assert prior["good"][1] == pytest.approx(-1.386294, abs=1e-6)
    tot = m.totals.first()
    assert (tot.n_total, tot.n_classes) == (5, 3)
    assert m.counts.count() == 21
    vf = [r.n_values for r in m.vocabulary.orderBy("feat_idx").collect()]
    assert vf == [1, 1, 1, 1, 2, 3]


def test_car_constant_features_have_zero_log_likelihood(car):
    _, m = car
    const = m.likelihood.filter("feat_idx < 4").collect()
    assert const and all(r.log_lik == 0.0 for r in const)
    assert all(r.log_lik <= 0.0 for r in m.likelihood.collect())


@pytest.mark.parametrize("scorer", ["map", "map_arrays", "long"])
def test_car_scores_and_predictions(car, scorer):
    p, m = car
    got = {}
    for r in class_scores(p, m, ["row_id"], scorer=scorer).collect():
        got.setdefault(r.row_id, {})[r["class"]] = r.score
    for rid, (_, scores, _) in CAR_SCORES.items():
        for cls, s in scores.items():
            assert got[rid][cls] == pytest.approx(s, abs=1e-6)
    pred = {r.row_id: r.prediction for r in predict(p, m, ["row_id"], scorer=scorer).collect()}
    assert pred == {rid: v[2] for rid, v in CAR_SCORES.items()}
    assert accuracy(predict(p, m, ["row_id"], scorer=scorer)).first().accuracy == 1.0


def test_mushroom_model(mushroom):
    _, m = mushroom
    prior = {r.label: (r.n_c, r.log_prior) for r in m.prior.collect()}
    assert prior["p"][0] == 2 and prior["e"][0] == 3
    assert prior["p"][1] == pytest.approx(-0.847298, abs=1e-6)
    assert prior["e"][1] == pytest.approx(-0.559616, abs=1e-6)
    assert m.counts.count() == 60
    vf = [r.n_values for r in m.vocabulary.orderBy("feat_idx").collect()]
    assert vf == [2, 2, 4, 2, 4, 1, 2, 2, 2, 2, 2, 1, 1, 1, 1, 1, 1, 1, 2, 2, 3, 3]


@pytest.mark.parametrize("scorer", ["map", "map_arrays", "long"])
def test_mushroom_scores(mushroom, scorer):
    p, m = mushroom
    got = {}
    for r in class_scores(p, m, ["row_id"], scorer=scorer).collect():
        got.setdefault(r.row_id, {})[r["class"]] = r.score
    for rid, (_, scores, _) in MUSHROOM_SCORES.items():
        for cls, s in scores.items():
            assert got[rid][cls] == pytest.approx(s, abs=1e-6)
    pred = {r.row_id: r.prediction for r in predict(p, m, ["row_id"], scorer=scorer).collect()}
    assert pred == {rid: v[2] for rid, v in MUSHROOM_SCORES.items()}


def test_model_table_kinds(car):
    _, m = car
    kinds = {r.kind: r.cnt for r in m.table.groupBy("kind").count().withColumnRenamed("count", "cnt").collect()}
    assert kinds == {"prior": 3, "likelihood": 21, "fallback": 6 * 3}


def test_save_and_load_roundtrip(spark, car, scratch):
    from tallybayes import NBModel

    p, m = car
    m.save(f"{scratch}/model")
    m2 = NBModel.load(spark, f"{scratch}/model")
    a = sorted((r.row_id, r.prediction, r.score) for r in predict(p, m, ["row_id"]).collect())
    b = sorted((r.row_id, r.prediction, r.score) for r in predict(p, m2, ["row_id"]).collect())
    assert a == b
