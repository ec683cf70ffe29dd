"""The folded row of a model: one aggregation chain for small models, joins for others, the same numbers."""

from __future__ import annotations

import pytest

from tallybayes import train
from tallybayes.operators.predict import predict

SCHEMA = "id bigint, dataset string, features array<string>, label string"
ROWS = [
    (1, "a", ["x", "p", "None"], "yes"),
    (2, "a", ["x", "q", "1"], "no"),
    (3, "a", ["y", "p", "2"], "no"),
    (4, "a", ["x", "p", "3"], "very_good"),
    (5, "b", ["x"], "yes"),
    (6, "b", ["z"], "maybe"),
    (7, "b", ["z"], None),
    (8, "c", [], "yes"),  # no features: nothing to count
]


def _rows(model, narrow):
    return {
        r["dataset"]: (r["classes"], r["prior"], {f: dict(v) for f, v in r["lik"].items() if f in narrow}, dict(r["fallback"]))
        for r in model.folded(narrow).collect()
    }


def _joined(counts):
    out = type(counts)(counts.counts, counts.keys)
    out.__dict__["_colocated"] = False
    return out


@pytest.mark.parametrize("narrow", [(0, 1, 2), (1,), (0,)])
def test_one_chain_equals_joins(spark, narrow):
    model = train(spark.createDataFrame(ROWS, SCHEMA))
    assert model._colocated
    got = _rows(model, narrow)
    assert got == _rows(_joined(model), narrow)
    assert sorted(got) == ["a", "b"]
    assert got["a"][0] == ["no", "very_good", "yes"] and got["b"][0] == ["maybe", "yes"]


def test_no_join_and_no_shuffle(spark):
    model = train(spark.createDataFrame(ROWS, SCHEMA))
    plan = model.folded((0, 1, 2))._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Exchange" not in plan


def test_sizes_and_empty_training_data(spark):
    model = train(spark.createDataFrame(ROWS, SCHEMA))
    st = model.stats()
    assert (st.n_models, st.max_classes, st.max_values, st.min_features, st.max_features) == (2, 3, 4, 1, 3)
    assert st.n_entries == 2 + 2 + 4 + 2 and st.dense_cells == 3 * 8 + 2 * 2
    none = train(spark.createDataFrame([], SCHEMA))
    assert none.stats().n_models == 0 and none.folded(()).count() == 0
    scored = predict(spark.createDataFrame(ROWS, SCHEMA), none, ["id"], scorer="map")
    assert {r["prediction"] for r in scored.collect()} == {None}
