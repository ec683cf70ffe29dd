"""Random small tables: Spark scorers equal a brute-force Python classifier."""

from __future__ import annotations

import math
from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tallybayes import DatasetSpec, accuracy, predict, prepare, train

LABELS = ["a", "b", "c_d", "e"]
VALUES = ["x", "y", "z_1", None]
M = 3
SPEC = DatasetSpec("prop", tuple(f"f{i}" for i in range(M)), "label", ("id",))
DDL = "id int, label string, " + ", ".join(f"f{i} string" for i in range(M))

row = st.tuples(st.sampled_from(LABELS), *[st.sampled_from(VALUES) for _ in range(M)])


def brute_force(train_rows, test_rows):
    """Direct transcription of the formulas, one test row at a time."""
    norm = lambda v: "None" if v is None else v
    n_c = Counter(r[0] for r in train_rows)
    total, k = sum(n_c.values()), len(n_c)
    counts = Counter((i, norm(r[1 + i]), r[0]) for r in train_rows for i in range(M))
    vocab = {i: len({norm(r[1 + i]) for r in train_rows}) for i in range(M)} if train_rows else {}
    out = {}
    for rid, r in test_rows:
        best, best_s = None, -math.inf
        for c in sorted(n_c):
            s = math.log((n_c[c] + 1) / (total + k))
            for i in range(M):
                v = norm(r[1 + i])
                if (i, v, c) in counts:
                    s += math.log((counts[(i, v, c)] + 1) / (n_c[c] + vocab[i]))
                elif i in vocab:
                    s += math.log(1 / (n_c[c] + vocab[i]))
                else:
                    s += math.log(1e-10)
            if s > best_s + 1e-12:
                best, best_s = c, s
        out[rid] = (best, None if best is None else best_s)
    return out


@settings(max_examples=12, deadline=None, derandomize=True, suppress_health_check=list(HealthCheck))
@given(train_rows=st.lists(row, min_size=0, max_size=25), test_rows=st.lists(row, min_size=1, max_size=10))
@pytest.mark.parametrize("scorer", ["map", "map_arrays", "long"])
def test_matches_brute_force(spark, scorer, train_rows, test_rows):
    tr = spark.createDataFrame([(i, *r) for i, r in enumerate(train_rows)], DDL)
    te_rows = [(1000 + i, *r) for i, r in enumerate(test_rows)]
    te = spark.createDataFrame(te_rows, DDL)
    model = train(prepare(tr, SPEC), durable=False)
    got = {r.id: (r.prediction, r.score) for r in predict(prepare(te, SPEC), model, ["id"], scorer=scorer).collect()}
    want = brute_force(train_rows, [(r[0], r[1:]) for r in te_rows])
    assert set(got) == set(want)
    for rid, (pred, score) in want.items():
        gp, gs = got[rid]
        assert gp == pred, (rid, got[rid], want[rid])
        if score is None:
            assert gs is None
        else:
            assert gs == pytest.approx(score, abs=1e-9)
    acc = accuracy(predict(prepare(te, SPEC), model, ["id"], scorer=scorer)).first().accuracy
    exp = sum(want[r[0]][0] == r[1] for r in te_rows) / len(te_rows)
    assert acc == pytest.approx(exp)
