from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallybayes.llm import queries, whitening

SCHEMA = "vec_id long, embedding array<float>, label int"
ODD = [None, [], [1.0] * 7 + [None], [1.0] * 7 + [math.nan], [1.0] * 7 + [math.inf]]


def centred(kind, rng):
    d, n = int(rng.integers(1, 30)), int(rng.integers(1, 70))
    a = rng.normal(size=(n, d))
    if kind == "graded":
        a *= 10.0 ** rng.uniform(-6, 6, d)
    elif kind == "integer":
        a = np.round(a)
    elif kind == "low rank":
        a = rng.normal(size=(n, min(3, d))) @ rng.normal(size=(min(3, d), d))
    elif kind == "equal":
        a = np.vstack([np.eye(d) * 5] * 2)
    elif kind == "pairs":
        q = np.linalg.qr(rng.normal(size=(d, d)))[0]
        a = np.vstack([q, -q]) * np.repeat(np.arange(1, d + 1) // 2 + 1, 1)
    return a - a.mean(axis=0)


@pytest.mark.parametrize("kind", ["plain", "graded", "integer", "low rank", "equal", "pairs"])
def test_directions_are_eigenvectors(kind):
    rng = np.random.default_rng(3)
    for _ in range(40):
        a = centred(kind, rng)
        r = np.linalg.qr(a, mode="r")
        values, v = whitening.directions(r, 4)
        full = np.zeros(a.shape[1])
        s = np.linalg.svd(a, compute_uv=False)
        full[: len(s)] = s**2
        top = max(full.max(), 1e-300)
        k = v.shape[1]
        assert np.abs(values - full).max() <= 1e-12 * top
        assert np.abs(v.T @ v - np.eye(k)).max(initial=0) <= 1e-11
        assert np.abs(a.T @ (a @ v) - v * values[:k]).max(initial=0) <= 1e-11 * top


def test_small_singular_values_are_accurate():
    # a graded bidiagonal matrix: all values to high relative accuracy
    d, e = 10.0 ** -np.arange(0, 30, 2), 10.0 ** -np.arange(0, 28, 2) / 3
    got = whitening.dqds(d, e)
    assert np.isclose(np.prod(np.sqrt(got) * 1e14), np.prod(d * 1e14), rtol=1e-12)  # the determinant
    assert np.all(np.diff(got) <= 0)


def expected(rows, k=4):
    keep = [(i, np.floor(256 * np.array(v, np.float32).astype(float)).astype(np.int64)) for i, v in rows if v and all(x is not None and math.isfinite(x) for x in v)]
    fit = np.unique(np.stack([x for _, x in keep]), axis=0)
    n, s = len(fit), fit.sum(axis=0)
    c = fit - s / n
    e, v = np.linalg.eigh(c.T @ c / n)
    e, v = e[::-1][:k], v[:, ::-1][:, :k]
    return n, s, e, v, np.trace(c.T @ c / n), keep


def test_query_equals_numpy(spark, scratch, monkeypatch):
    monkeypatch.setattr(whitening, "FAN", 2)
    rng = np.random.default_rng(1)
    turn = rng.normal(size=(8, 8)) * 10.0 ** -np.arange(8)[:, None] * 30
    rows = [(i, [float(np.float32(x)) for x in v]) for i, v in enumerate(rng.normal(size=(300, 8)) @ turn)]
    rows += [rows[3], (400, rows[4][1]), (None, rows[5][1]), (401, [0.0] * 8), (402, [-0.0] * 8)]
    odd = [(500 + i, v) for i, v in enumerate(ODD)]
    df = spark.createDataFrame([(i, v, 1) for i, v in rows + odd], SCHEMA).withColumn("v", F.lit("x")).withColumn("dim", F.lit(3))
    df.repartition(7).write.parquet(f"{scratch}/embeddings.parquet")
    got = queries.op12_whitening(spark, scratch).collect()
    n, s, e, v, trace, keep = expected(rows)
    assert len(got) == 4 * len(keep)
    assert {r["n"] for r in got} == {n}
    assert len({r["identity_error"] for r in got}) == 1 and got[0]["identity_error"] <= 1e-9
    by = {}
    for r in got:
        by.setdefault((r["vec_id"], r["component"]), []).append(r)
    sign = {}
    for i, x in keep:
        for c in range(4):
            r = by[i, c + 1].pop()
            want = float((x - s / n) @ v[:, c] / math.sqrt(e[c]))
            if abs(want) > 0.01:
                sign.setdefault(c, math.copysign(1, want * r["whitened"]))
            assert abs(r["whitened"] - sign.get(c, 1) * want) <= 1e-7
            assert r["deviation"] == sum((n * int(a) - int(b)) ** 2 for a, b in zip(x, s, strict=True))
            assert math.isclose(r["explained"], e[c] / trace, rel_tol=1e-9)


def test_query_on_the_given_table(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "embedding").collect()]
    n, s, e, v, trace, keep = expected(rows)
    got = {(r["vec_id"], r["component"]): r for r in queries.op12_whitening(spark, sf).collect()}
    assert len(got) == 4 * len(keep)
    for c in range(4):
        w = np.array([got[i, c + 1]["whitened"] for i, _ in keep])
        want = np.array([(x - s / n) @ v[:, c] for _, x in keep]) / math.sqrt(e[c])
        assert min(np.abs(w - want).max(), np.abs(w + want).max()) <= 1e-9
        assert math.isclose(got[keep[0][0], c + 1]["explained"], e[c] / trace, rel_tol=1e-10)


def test_degenerate_tables(spark):
    def run(rows):
        return whitening.whiten(spark.createDataFrame(rows, SCHEMA))

    assert run([]).count() == 0
    assert run([(i, v, 1) for i, v in enumerate(ODD)]).count() == 0
    assert run([(1, [1.0, 2.0], 1), (2, [1.0, 2.0], 1)]).count() == 0  # one distinct vector varies in nothing
    got = run([(1, [1.0, 2.0], 1), (2, [3.0, 2.0], 1), (3, [5.0], 1)]).collect()  # rank 1; lengths apart
    assert [(r["component"], r["n"], round(abs(r["whitened"]), 9), r["explained"]) for r in got] == [(1, 2, 1.0, 1.0)] * 2
    big = run([(1, [3e38, 1.0], 1), (2, [-3e38, 2.0], 1), (3, [0.0, 3.0], 1)]).collect()  # floors saturate; sums are exact
    assert {r["deviation"] for r in big} == {None, (3 * 768 - 1536) ** 2 + 1}
